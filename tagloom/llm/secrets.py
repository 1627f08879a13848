"""Secrets in texts: known shapes, and strings of high entropy.

Any long run of key characters is a candidate. A window slides over it; the
entropy of the window follows from the counts of its characters, which change
by one character in and one out. The highest entropy of a window counts
against the limit of the candidate's character class. Known harmless shapes
are suppressed. Only built-in functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import id_and_text
from tagloom.llm.spans import find_all, let

# Shapes of the known kinds; fixed values.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]++"""
ASSIGN_KEY = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]{14,}+"  # a shorter run has no longer one within
HEX = r"[0-9a-f]{16,}+"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}+"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"

KINDS = ("assign", "access", "hex", "entropy")
BASE_KINDS = KINDS[:3]

# Harmless shapes: one character over and over, digits, plain or hyphenated words, UUIDs, placeholders.
ALLOWED = (
    r"^(.)\1*$",
    r"^[0-9]+$",
    r"^[A-Za-z]+$",
    r"^[A-Za-z]+(?:[-_/][A-Za-z]+)*+$",
    r"^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
    r"(?i)example|placeholder|changeme|xxxx",
)


@dataclass(frozen=True)
class EntropySettings:
    window: int = 20
    hex_bits: float = 3.0  # candidates of hexadecimal digits
    alnum_bits: float = 3.6  # of letters and digits
    any_bits: float = 3.8  # of all key characters
    allowed: tuple[str, ...] = ALLOWED


def window_entropy(value: Column, window: int) -> Column:
    """Highest Shannon entropy, in bits, of any window of a string of key characters.

    Null for strings shorter than the window.
    """
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))

    def weight(n: Column) -> Column:
        return F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(0.0)

    def best(code: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            come = F.get(code, i)
            go = F.when(i >= window, F.get(code, i - window)).otherwise(0)
            n_come = F.get(acc["counts"], come)
            n_go = F.get(acc["counts"], go)
            moved = weight(n_come + 1) - weight(n_come) + F.when(go > 0, weight(n_go - 1) - weight(n_go)).otherwise(0.0)
            counts = F.transform(
                acc["counts"], lambda n, j: n + F.when(j == come, 1).otherwise(0) - F.when(j == go, 1).otherwise(0)
            )
            total = F.when(come == go, acc["total"]).otherwise(acc["total"] + moved)
            bits = F.log2(F.lit(float(window))) - total / window
            return F.struct(
                F.when(come == go, acc["counts"]).otherwise(counts).alias("counts"),
                total.alias("total"),
                F.when(i >= window - 1, F.greatest(acc["bits"], bits)).otherwise(acc["bits"]).alias("bits"),
            )

        first = F.struct(
            F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("counts"),
            F.lit(0.0).alias("total"),
            F.lit(None).cast("double").alias("bits"),
        )
        return F.aggregate(F.sequence(F.lit(0), F.size(code) - 1), first, step, lambda acc: acc["bits"])

    return let(codes, best)


def is_random(value: Column, settings: EntropySettings) -> Column:
    limit = (
        F.when(F.rlike(value, F.lit("^[0-9a-fA-F]+$")), settings.hex_bits)
        .when(F.rlike(value, F.lit("^[0-9A-Za-z]+$")), settings.alnum_bits)
        .otherwise(settings.any_bits)
    )
    allowed = F.lit(False)
    for pattern in settings.allowed:
        allowed = allowed | F.rlike(value, F.lit(pattern))
    return F.when(allowed, False).otherwise(window_entropy(value, settings.window) >= limit)


def tagged(spans: Column, kind: str, kinds: tuple[str, ...]) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(s["start"], F.lit(kinds.index(kind)).alias("place"), s["end"], F.lit(kind).alias("kind")),
    )


def find_secrets(
    df: DataFrame, settings: EntropySettings = EntropySettings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Spans of secrets in every whole text.

    Returns one row per input row: the id and ``spans``, an array of
    ``(start, place, end, kind)`` by start and the order of ``KINDS``. Spans
    of different kinds may overlap. Null and empty texts have an empty array.
    Repeated rows and null ids stay; other columns are not carried.
    """
    rows = id_and_text(df, id_col, text_col)
    return rows.select(id_col, secret_spans(F.col("text"), settings).alias("spans"))


def secret_spans(text: Column, settings: EntropySettings = EntropySettings()) -> Column:
    """The spans ``find_secrets`` returns, as an expression on one text."""
    assign = F.filter(
        find_all(text, ASSIGN), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN_KEY, 1)) >= 12
    )
    found = {
        "assign": assign,
        "access": find_all(text, ACCESS),
        "hex": find_all(text, HEX),
        "entropy": F.filter(find_all(text, CANDIDATE), lambda s: is_random(s["value"], settings)),
    }
    return F.array_sort(F.concat(*[tagged(found[k], k, KINDS) for k in KINDS]))


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every stretch that spans cover replaced by one mark.

    ``spans`` is sorted by start, as ``secret_spans`` gives it.
    """
    first = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], between, F.lit(mark))).otherwise(acc["out"])
        return F.struct(out.alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    rest = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, first, step, rest)).otherwise(text)
