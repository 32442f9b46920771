"""Small fixed tables of the variant grammar, as plain values and as Spark columns."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Residues by one letter and three.
ONE_TO_THREE = {
    "A": "Ala", "R": "Arg", "N": "Asn", "D": "Asp", "C": "Cys", "Q": "Gln", "E": "Glu", "G": "Gly", "H": "His", "I": "Ile",
    "L": "Leu", "K": "Lys", "M": "Met", "F": "Phe", "P": "Pro", "S": "Ser", "T": "Thr", "W": "Trp", "Y": "Tyr", "V": "Val",
    "B": "Asx", "Z": "Glx", "X": "Ter",
}
THREE_TO_ONE = {three.upper(): one for one, three in ONE_TO_THREE.items()} | {"XAA": "X"}
# Residue names by three letters.
NAME_TO_THREE = {
    "ALANINE": "ALA", "ARGININE": "ARG", "ASPARAGINE": "ASN", "ASPARTIC": "ASP", "ASPARTICACID": "ASP", "ASPARTATE": "ASP", "CYSTEINE": "CYS",
    "GLUTAMINE": "GLN", "GLUTAMIC": "GLU", "GLUTAMICACID": "GLU", "GLUTAMATE": "GLU", "GLYCINE": "GLY", "HISTIDINE": "HIS", "ISOLEUCINE": "ILE",
    "LEUCINE": "LEU", "LYSINE": "LYS", "METHIONINE": "MET", "PHENYLALANINE": "PHE", "PROLINE": "PRO", "SERINE": "SER", "THREONINE": "THR",
    "TRYPTOPHAN": "TRP", "TYROSINE": "TYR", "VALINE": "VAL", "STOP": "XAA", "TERM": "XAA", "TERMINATION": "XAA",
}
NAME_TO_THREE |= {f"{name}CODON": three for name, three in NAME_TO_THREE.items()}
# Names of bases, numbers as words, words for types of variants.
BASES = {"ADENINE": "A", "CYTOSINE": "C", "GUANINE": "G", "URACIL": "U", "THYMINE": "T", "ADENOSINE": "A", "CYTIDINE": "C", "THYMIDINE": "T", "GUANOSINE": "G", "URIDINE": "U"}
NUMBER_WORDS = {"ZERO": "0", "SINGLE": "1", "ONE": "1", "TWO": "2", "THREE": "3", "FOUR": "4", "FIVE": "5", "SIX": "6", "SEVEN": "7", "EIGHT": "8", "NINE": "9"}
TYPE_WORDS = {
    "INSERT": "INS", "INSERTION": "INS", "INSERTED": "INS", "INSERTING": "INS", "DUPLICATE": "DUP", "DUPLICATION": "DUP", "DUPLICATED": "DUP", "DUPLICATING": "DUP",
    "DELETE": "DEL", "DELETION": "DEL", "DELETED": "DEL", "DELETING": "DEL", "INSERTION/DELETION": "INDEL", "DELETION/INSERTION": "INDEL", "INSERTIONDELETION": "INDEL",
    "DELETIONINSERTION": "INDEL", "DELINS": "INDEL", "LACK": "DEL", "LACKED": "DEL", "LACKING": "DEL", "LOSE": "DEL", "LOSING": "DEL", "LOSED": "DEL", "COPY": "DUP",
    "REPEAT": "DUP", "REPEATED": "DUP", "DELTA": "DEL", "D": "DEL",
}
# The genetic code in the order T, C, A, G of each base; * ends a protein.
CODE_ORDER, CODE = "TCAG", "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
# Display names of entity types.
LABELS = {
    "ProteinMutation": "Protein Mutation", "DNAMutation": "DNA Mutation", "SNP": "SNP", "ProteinAllele": "Protein Allele", "DNAAllele": "DNA Allele",
    "AcidChange": "Acid Change", "OtherMutation": "Other Mutation", "Gene": "Gene", "Species": "Species", "CellLine": "Cell Line",
}
GENE_TYPES = ("Gene",)
ORGANISM_TYPES = ("Species", "CellLine")


def codons() -> dict[str, str]:
    """Codon -> residue, X for the end; DNA and RNA letters."""
    triples = [a + b + c for a in CODE_ORDER for b in CODE_ORDER for c in CODE_ORDER]
    dna = {t: r.replace("*", "X") for t, r in zip(triples, CODE, strict=True)}
    return dna | {t.replace("T", "U"): r for t, r in dna.items()}


def single_base_changes() -> list[tuple[str, str, str, str]]:
    """Residue pairs and the base changes in a codon that turn one into the other: (aa_w, aa_m, nu_w, nu_m)."""
    code = {c: r for c, r in codons().items() if "U" not in c}
    out = set()
    for codon, residue in code.items():
        for i in range(3):
            for base in "ACGT":
                if base != codon[i]:
                    out.add((residue, code[codon[:i] + base + codon[i + 1 :]], codon[i], base))
    return sorted(out)


def lookup(mapping: dict[str, str]) -> Column:
    """A literal map for element access."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(sorted(mapping.items()))])


def mapped(mapping: dict[str, str], key: Column, default: Column) -> Column:
    return F.coalesce(lookup(mapping)[key], default)
