"""Column functions of texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Greek letters and signs as single ASCII letters.
GREEK = "αβγδεζηθικλμνξοπρστυφχψωΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"
GREEK_ASCII = "abrdezitiklmvxoprstyfxpoABGDEZHTIKLMNXOPRSTYFXPO"
SIGNS = "–—−‐‑’‘“”àáâãäåçèéêëìíîïñòóôõöùúûüý"
SIGNS_ASCII = "-----''\"\"aaaaaaceeeeiiiinooooouuuuy"


def clean_text(c: Column) -> Column:
    """Without characters that can't be printed; tabs and line ends stay (B2)."""
    return F.regexp_replace(c, r"[^\P{C}\t\r\n]", "")


def delimit_table_passage(ptype: Column, text: Column) -> Column:
    """In tables blanks become ``;`` but for those around ``>``."""
    return F.when(F.lower(ptype) == "table", F.replace(F.replace(text, F.lit(" "), F.lit(";")), F.lit(";>;"), F.lit(" > "))).otherwise(text)


def fold_unicode(c: Column, gamma: str = "r") -> Column:
    """Greek and accented letters as ASCII; gamma as the tagger (r) or the reader (g) has it."""
    return F.translate(c, GREEK + SIGNS, GREEK_ASCII.replace("r", gamma, 1) + SIGNS_ASCII)


def document_key(stem: Column) -> Column:
    """Numbers as they are, else md5 modulo 10^8, exact over all 128 bits."""
    digest = F.md5(stem)
    mod = F.lit(100_000_000).cast("bigint")
    # 16^4 at a time, so that no step leaves 64 bits
    total = F.lit(0).cast("bigint")
    for k in range(8):
        total = (total * 65536 + F.conv(F.substring(digest, 4 * k + 1, 4), 16, 10).cast("bigint")) % mod
    return F.when(stem.rlike("^[0-9]+$"), stem).otherwise(total.cast("string"))


def char_count(c: Column) -> Column:
    return F.length(F.coalesce(c, F.lit(""))).cast("bigint")


def word_count(c: Column) -> Column:
    """Words between white space, 0 for none."""
    bare = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, " "))).cast("bigint")


def path_category(rel: Column) -> Column:
    """What a report file is, from its path below the output folder."""
    parts = F.split(rel, "/")
    n = F.size(parts)
    return F.when(n == 1, "Main Publication").when(n == 2, "Supplementary PDF").when(n == 3, "Supplementary Spreadsheet").otherwise("Other")


def path_label(rel: Column) -> Column:
    parts = F.split(rel, "/")
    stem = F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "")
    return F.when(F.size(parts) == 3, F.concat(F.element_at(parts, -2), F.lit(" / "), stem)).otherwise(stem)


def display_count(n: Column) -> Column:
    """999, 1.5k, 142k, 1.4m."""
    def unit(x: Column, name: str) -> Column:
        return F.concat(F.when(x < 10, F.regexp_replace(F.format_string("%.1f", x), r"\.0$", "")).otherwise(F.format_string("%.0f", F.floor(x).cast("double"))), F.lit(name))

    x = n.cast("double")
    return F.when(n < 1000, n.cast("string")).when(n < 1_000_000, unit(x / 1000, "k")).otherwise(unit(x / 1_000_000, "m"))


def display_seconds(s: Column) -> Column:
    """1h 2m 3s, leading zeros left out."""
    h, m, r = F.floor(s / 3600), F.floor((s % 3600) / 60), F.floor(s % 60)
    return F.when(h > 0, F.format_string("%dh %dm %ds", h, m, r)).when(m > 0, F.format_string("%dm %ds", m, r)).otherwise(F.format_string("%ds", r))


def parse_details(c: Column) -> Column:
    """``k:v;k:v`` as a map: the first colon splits, parts without one are left out, the last of a key wins."""
    parts = F.filter(F.split(c, ";"), lambda x: x.contains(":"))
    entries = F.transform(parts, lambda x: F.struct(F.substring_index(x, ":", 1).alias("key"), F.substring(x, F.length(F.substring_index(x, ":", 1)) + 2, F.length(x)).alias("value")))

    def last(all_: Column) -> Column:
        return F.filter(all_, lambda e, i: ~F.exists(F.slice(all_, i + 2, F.greatest(F.size(all_), F.lit(1))), lambda o: o["key"] == e["key"]))

    # a text is split once, not anew for each of its entries
    return F.map_from_entries(F.transform(F.array(entries), last)[0])
