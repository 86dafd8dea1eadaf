"""Secret scan with column expressions only (no Python on the executors).

Base spans come from three patterns (assignments of named secrets, access keys,
long hexadecimal runs).  On top of them, candidate strings -- runs of 20 and
more characters that credentials are written in, with a letter and a digit --
are read with a sliding window of 20 characters.  The window keeps the sum of
``c * log2(c)`` over the counts of its characters; a step takes one character in
and one out, which changes two counts, so the Shannon entropy ``log2(w) - sum / w``
follows from how often these two occur among the other 19.  The sum is kept in
whole units of 2^-40, so it does not drift however long a run is, and a step
costs the same at every length.

A run is of the hexadecimal class if it holds hexadecimal digits only, in either
case (upper and lower case then count as one), and of the base 64 class
otherwise.  It is reported from the first to the last window whose entropy
reaches the class threshold.

The allow list holds well-known harmless strings (placeholders, alphabets): a
window does not count if one lies in it or within 20 characters before or after
it, so a placeholder quiets its surroundings, not a key further on in the same
run.  Runs that are UUIDs are left out, and so are added spans inside a base
span.  Base spans are never suppressed.  Offsets count code points; the end is
exclusive.

Null text counts as empty: no spans.  Every row is scanned by itself, so
repeated rows, null ids and empty tables need no special treatment.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Candidate strings: possessive runs, so a run is read once.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,}+"

#: Classes: (name, entropy in bits that a window must reach).
HEX_CLASS = ("entropy_hex", 3.0)
BASE64_CLASS = ("entropy_base64", 3.8)
WINDOW = 20
HEX_RUN = "^[0-9a-fA-F]+$"
#: Harmless strings; windows near one do not count.
ALLOW = r"(?i)example|placeholder|changeme|your[_-]?|xxxx|0123456789|1234567890|abcdefgh"
UUID_RUN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
#: Entropy may fall this much short of the threshold.
_SLACK = 1e-9
#: Units of the running sum.
_UNIT = 1 << 40
#: Matches whose places are summed in one step.
_BLOCK = 64

_SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"


def _sums_before(values: Column) -> Column:
    """For each value of an array of long, the sum of those before it.

    Blocks of :data:`_BLOCK` values are summed apart and then shifted, so the cost
    does not grow with the square of the length.
    """
    zero = F.lit(0).cast("bigint")

    def chain(numbers: Column) -> Column:
        """0 and the running sums; as long as ``numbers`` and one more."""
        return F.aggregate(numbers, F.array(zero), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    def with_values(whole: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(whole) - 1) / _BLOCK).cast("int")),
            lambda b: F.slice(whole, b * _BLOCK + 1, F.lit(_BLOCK)),
        )

        def with_blocks(parts: Column) -> Column:
            totals = F.transform(parts, lambda p: F.aggregate(p, zero, lambda acc, x: acc + x))

            def with_shifts(shifts: Column) -> Column:
                return F.flatten(
                    F.transform(
                        parts,
                        lambda p, b: F.transform(
                            F.slice(chain(p), 1, F.size(p)), lambda x: x + F.element_at(shifts, b + 1)
                        ),
                    )
                )

            return _let(chain(totals), with_shifts)

        return _let(blocks, with_blocks)

    return F.when(F.size(values) > 0, _let(values, with_values)).otherwise(F.expr("cast(array() as array<bigint>)"))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _placed(text: Column, pattern: str, kind: str) -> Column:
    """Matches of ``pattern`` with their places: array of (kind, start, end, match)."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(found.alias("m"), F.slice(gaps, 1, F.size(found)).alias("g"))

    def with_pairs(zipped: Column) -> Column:
        # A match starts after all gaps up to its own and all matches before it.
        lengths = F.transform(zipped, lambda x: (x["g"] + F.length(x["m"])).cast("bigint"))
        return F.transform(
            F.arrays_zip(zipped.alias("x"), _sums_before(lengths).alias("at")),
            lambda z: F.struct(
                F.lit(kind).alias("kind"),
                (z["at"] + z["x"]["g"]).alias("start"),
                (z["at"] + z["x"]["g"] + F.length(z["x"]["m"])).alias("end"),
                z["x"]["m"].alias("match"),
            ),
        )

    none = F.expr("cast(array() as array<struct<kind:string,start:bigint,end:bigint,match:string>>)")
    return F.when(text.rlike(pattern), _let(pairs, with_pairs)).otherwise(none)


def _units(count: int) -> int:
    """``c * log2(c)`` in units."""
    return round(count * math.log2(count) * _UNIT) if count > 1 else 0


def window_sums(chars: Column, window: int) -> Column:
    """How the sum of ``c * log2(c)`` over the last ``window`` characters changes at each
    position of an array of characters (in units).

    The character that comes in and the one that goes out are counted among the
    ``window - 1`` characters between them.
    """
    gain = F.array(*[F.lit(_units(c + 1) - _units(c)) for c in range(window)])

    def change(char: Column, i: Column) -> Column:
        between = F.slice(chars, F.greatest(i - (window - 2), F.lit(1)), F.least(i, F.lit(window - 1)))
        gone = F.get(chars, i - window)
        coming = F.element_at(gain, F.size(F.filter(between, lambda c: c == char)) + 1)
        going = F.element_at(gain, F.size(F.filter(between, lambda c: c == gone)) + 1)
        return coming - F.when(i >= window, going).otherwise(F.lit(0))

    return F.transform(chars, change)


def _first_and_last(chars: Column, least: float, quiet: Column, window: int) -> Column:
    """(first, last) start of the windows that count, or nulls.

    ``quiet``: whether the run holds a string of the allow list at all.
    """
    most = int((math.log2(window) - least + _SLACK) * window * _UNIT)

    def near_allowed(last: Column) -> Column:
        start = F.greatest(last - (2 * window - 2), F.lit(1))
        around = F.slice(chars, start, last + 1 + window - start + 1)
        return F.array_join(around, "").rlike(ALLOW)

    def step(acc: Column, x: Column) -> Column:
        total = acc["total"] + x
        low = (acc["i"] >= window - 1) & (total <= most)
        counts = F.when(low, F.when(quiet, ~near_allowed(acc["i"])).otherwise(True)).otherwise(False)
        start = acc["i"] - (window - 1)
        return F.struct(
            total.alias("total"),
            (acc["i"] + 1).alias("i"),
            F.when(acc["first"].isNull() & counts, start).otherwise(acc["first"]).alias("first"),
            F.when(counts, start).otherwise(acc["last"]).alias("last"),
        )

    nothing = F.lit(None).cast("int")
    state = F.struct(
        F.lit(0).cast("bigint").alias("total"),
        F.lit(0).alias("i"),
        nothing.alias("first"),
        nothing.alias("last"),
    )
    return F.aggregate(window_sums(chars, window), state, step)


def _entropy_spans(candidates: Column, base: Column, window: int) -> Column:
    def judged(c: Column) -> Column:
        # Looked up once for each run, not at each of its windows.
        return _let(c["match"].rlike(ALLOW), lambda quiet: of_class(c, quiet))

    def of_class(c: Column, quiet: Column) -> Column:
        def span(cls, run: Column) -> Column:
            name, least = cls

            def found(chars: Column) -> Column:
                return _let(
                    _first_and_last(chars, least, quiet, window),
                    lambda w: F.when(
                        w["first"].isNotNull(),
                        F.struct(
                            F.lit(name).alias("kind"),
                            (c["start"] + w["first"]).cast("bigint").alias("start"),
                            (c["start"] + w["last"] + window).cast("bigint").alias("end"),
                        ),
                    ),
                )

            return _let(F.split(run, ""), found)

        is_hex = c["match"].rlike(HEX_RUN)
        return F.when(is_hex, span(HEX_CLASS, F.lower(c["match"]))).otherwise(span(BASE64_CLASS, c["match"]))

    allowed = F.filter(candidates, lambda c: ~c["match"].rlike(UUID_RUN) & c["match"].rlike("[A-Za-z]"))
    spans = F.filter(F.transform(allowed, judged), lambda s: s.isNotNull())
    return F.filter(
        spans,
        lambda s: ~F.exists(base, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])),
    )


def scan_secrets(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """One row per document row: the id, ``base`` and ``added`` spans (kind, start, end),
    each ordered by start and then kind."""
    text = F.coalesce(F.col("__text"), F.lit(""))

    def plain(spans: Column) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
        )

    # The value of an assignment is what follows the name, the sign and the quotes.
    value = r"""(?i)^(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
    found = documents.select(F.col(id_col).alias(id_col), F.col(text_col).alias("__text")).select(
        id_col,
        F.filter(
            _placed(text, ASSIGN, "assign"),
            lambda s: F.length(F.regexp_replace(s["match"], value, "")) >= 6,
        ).alias("__assign"),
        _placed(text, ACCESS, "access").alias("__access"),
        _placed(text, HEX, "hex").alias("__hex"),
        _placed(text, CANDIDATE, "candidate").alias("__candidates"),
    )
    rank = {"assign": 0, "access": 1, "hex": 2}

    def ordered(spans: Column) -> Column:
        place = F.create_map(*[F.lit(v) for pair in rank.items() for v in pair])
        keyed = F.array_sort(
            F.transform(
                spans,
                lambda s: F.struct(
                    s["start"].alias("start"),
                    F.coalesce(F.element_at(place, s["kind"]), F.lit(3)).alias("rank"),
                    s["kind"].alias("kind"),
                    s["end"].alias("end"),
                ),
            )
        )
        return plain(keyed)

    with_base = found.withColumn("base", ordered(plain(F.concat("__assign", "__access", "__hex"))))
    return with_base.select(
        id_col,
        "base",
        ordered(
            F.when(
                F.size("__candidates") > 0,
                _entropy_spans(F.col("__candidates"), F.col("base"), window),
            ).otherwise(F.expr(f"cast(array() as {_SPAN})"))
        ).alias("added"),
    )


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def digest(scanned: DataFrame) -> DataFrame:
    """Counts, base fingerprint and all spans of :func:`scan_secrets` rows."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    place = {"assign": 0, "access": 1, "hex": 2}
    ranks = F.create_map(*[F.lit(v) for pair in place.items() for v in pair])
    together = F.array_sort(
        F.transform(
            F.concat("base", "added"),
            lambda s: F.struct(
                s["start"].alias("start"),
                F.coalesce(F.element_at(ranks, s["kind"]), F.lit(3)).alias("rank"),
                s["kind"].alias("kind"),
                s["end"].alias("end"),
            ),
        )
    )
    return scanned.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(together).alias("spans"),
    )
