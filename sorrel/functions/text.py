"""Text and sequence functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: IUPAC bases and their complements.
IUPAC, COMPLEMENT = "ACGTRYSWKMBDHVNacgtryswkmbdhvn", "TGCAYRSWMKVHDBNtgcayrswmkvhdbn"
#: Nearest-neighbour enthalpy (kcal/mol) and entropy (cal/K/mol) of DNA/DNA, SantaLucia (1998).
NEAREST = {"AA": (-7.9, -22.2), "TT": (-7.9, -22.2), "AT": (-7.2, -20.4), "TA": (-7.2, -21.3), "CA": (-8.5, -22.7), "TG": (-8.5, -22.7), "GT": (-8.4, -22.4), "AC": (-8.4, -22.4), "CT": (-7.8, -21.0), "AG": (-7.8, -21.0), "GA": (-8.2, -22.2), "TC": (-8.2, -22.2), "CG": (-10.6, -27.2), "GC": (-9.8, -24.4), "GG": (-8.0, -19.9), "CC": (-8.0, -19.9)}


def natural_key(name: str) -> list[Column]:
    """Sort keys of names such as Chr2 and Chr10: names with a number at the end first, by prefix and number, then the raw name."""
    digits = F.regexp_extract(name, r"^(.*?)(\d+)$", 2)
    return [digits == "", F.when(digits == "", F.col(name)).otherwise(F.regexp_extract(name, r"^(.*?)(\d+)$", 1)), digits.try_cast("bigint"), F.col(name)]


def reverse_complement(sequence: str) -> Column:
    return F.reverse(F.translate(F.col(sequence), IUPAC, COMPLEMENT))


def gc_fraction(sequence: str) -> Column:
    return F.length(F.regexp_replace(sequence, "[^GC]", "")) / F.length(sequence)


def longest_run(sequence: str) -> Column:
    return F.expr(f"array_max(transform(regexp_extract_all({sequence}, r'((.)\\2*)', 1), x -> length(x)))")


def complementary_run(first: str, second: str) -> Column:
    """Longest tract of `first` that also stands in the reverse complement of `second`: a tract of k holds one of k - 1, so lengths are tried upwards to the first that none has."""
    tract = f"exists(sequence(1, length({first}) - k + 1), i -> contains(r, substring({first}, i, k)))"
    longest = f"aggregate(sequence(1, length({first})), 0, (best, k) -> if(best = k - 1, if({tract}, k, best), best))"
    return F.expr(f"transform(array(reverse(translate({second}, 'ACGT', 'TGCA'))), r -> {longest})[0]")


def melting_celsius(sequence: str, sodium_mm: float = 50.0, strand_nm: float = 25.0) -> Column:
    """Nearest-neighbour melting temperature of a perfect duplex with an entropy salt correction, of upper-case ACGT oligos of two bases or more."""
    pairs = f"transform(sequence(1, length({sequence}) - 1), i -> substring({sequence}, i, 2))"

    def summed(k: int) -> str:
        table = "map(" + ", ".join(f"'{p}', {v[k]}D" for p, v in NEAREST.items()) + ")"
        ends = [f"if(substring({sequence}, {at}, 1) in ('A', 'T'), {(2.3, 4.1)[k]}D, {(0.1, -2.8)[k]}D)" for at in (1, -1)]
        return f"({ends[0]} + {ends[1]} + aggregate({pairs}, 0D, (a, p) -> a + coalesce({table}[p], 0D)))"

    own = f"({sequence} = reverse(translate({sequence}, 'ACGT', 'TGCA')))"
    entropy = f"({summed(1)} - if({own}, 1.4D, 0D) + 0.368D * (length({sequence}) - 1) * ln({sodium_mm * 1e-3!r}D))"
    return F.expr(f"1000D * {summed(0)} / ({entropy} + 1.987D * ln({strand_nm * 1e-9!r}D / if({own}, 1D, 2D))) - 273.15D")


def percent_encode(text: str) -> Column:
    """As in URLs, with no character left safe but letters, digits and _.-~"""
    return F.replace(F.replace(F.replace(F.url_encode(text), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def percent_decode(text: str) -> Column:
    return F.url_decode(F.replace(F.col(text), F.lit("+"), F.lit("%2B")))


def identity(prefix: str, *pairs: tuple[str, str]) -> Column:
    """A stable id: 20 hexadecimal digits of the SHA-256 of a sorted, indented JSON object of the named columns (numbers bare, text quoted) and a line feed."""
    parts = []
    for name, kind in sorted(pairs):
        value = F.to_json(F.struct(F.col(name).alias("v")))
        parts.append(F.concat(F.lit(f'  "{name}": '), F.col(name).cast("string") if kind == "number" else F.regexp_extract(value, r'^\{"v":(.*)\}$', 1)))
    text = F.concat(F.lit("{\n"), F.concat_ws(",\n", *parts), F.lit("\n}\n"))
    return F.concat(F.lit(prefix), F.substring(F.sha2(text, 256), 1, 20))
