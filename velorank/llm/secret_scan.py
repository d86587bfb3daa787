"""Secrets in texts: known forms, and strings that pass for random (DataFrame functions only).

A candidate is a long run of letters, digits and a few signs.  Its encoding is
inferred from the characters it uses, and three tests ask whether it could be a
uniform random string of that alphabet: chi-squared over the alphabet, runs above
and below its middle, and serial correlation.  Ordinary words fail at least one.
How large the joint p-value must be is decided per class of lengths, from all
distinct candidates of the corpus: random strings have evenly spread p-values, so their
number shows in the upper half, and the threshold is the lowest at which the
estimated share of other strings among those reported stays within ``false_share``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velorank.llm.common import unused, whole_text

# The known forms and the lengths they must have.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
ACCESS = "AKIA[A-Z0-9]+"
ACCESS_LENGTH = 18
HEX = "[0-9a-f]+"
HEX_LENGTH = 16
KINDS = ("assign", "access", "hex", "random")
REPLACEMENT = "[REDACTED]"

_SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"
_MATCHES = "array<struct<start:bigint,end:bigint,m:string>>"
_HEX_ALPHABET = "0123456789abcdef"
_UPPER_HEX_ALPHABET = "0123456789ABCDEF"
_BASE32_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE64_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_P_BINS = 100


@dataclass(frozen=True)
class Battery:
    """``least_length``: shortest candidate; below it the tests can't tell words from
    random strings.  ``floor``: candidates below this p-value are never reported.
    ``false_share``: estimated share of non-random strings allowed among the reported.
    """

    least_length: int = 20
    floor: float = 0.01
    false_share: float = 0.1

    @property
    def pattern(self) -> str:
        return f"[A-Za-z0-9+/_-]{{{self.least_length},}}"


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _found(text: Column, pattern: str) -> Column:
    """Start, end (code points) and content of the leftmost matches that don't overlap.

    What lies between the matches gives their places.
    """
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(_MATCHES).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + F.length(x["m"])
        found = F.struct(begin.alias("start"), end.alias("end"), x["m"].alias("m"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(found)).alias("out"))

    def placed(whole: Column) -> Column:
        gaps = F.zip_with(F.split(text, pattern, -1), whole, lambda gap, m: F.struct(F.length(gap).alias("gap"), m.alias("m")))
        pairs = F.filter(gaps, lambda x: x["m"].isNotNull())  # the last gap has no match after it
        return F.when(F.size(whole) > 0, F.aggregate(pairs, start, step, lambda acc: acc["out"])).otherwise(F.array().cast(_MATCHES))

    return _bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _spans(found: Column, kind: int) -> Column:
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"))).cast(_SPAN)


def base_spans(text: Column) -> Column:
    """Spans of the known forms, by start and then kind.

    Matches of any length are taken first and failing ones dropped after, as the
    characters of a failing match are used up.  For the last two forms a run that
    is long enough is what is left, so only those are matched.
    """
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1))
    kept = F.filter(
        F.zip_with(_found(text, ASSIGN), values, lambda x, v: F.struct(x.alias("x"), v.alias("v"))),
        lambda pair: F.length(pair["v"]) >= ASSIGN_VALUE,
    )
    assign = F.transform(kept, lambda pair: pair["x"])
    access = _found(text, f"AKIA[A-Z0-9]{{{ACCESS_LENGTH - 4},}}")
    hexes = _found(text, f"[0-9a-f]{{{HEX_LENGTH},}}")
    return F.array_sort(F.concat(_spans(assign, 0), _spans(access, 1), _spans(hexes, 2)))


# The tests


def _two_sided(z: Column) -> Column:
    """Chance of a standard normal value at least this far from 0 (Abramowitz and Stegun 7.1.26)."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.3275911 * x)
    series = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), series * F.exp(-x * x)))


def _count(values: Column, keep) -> Column:
    return F.size(F.filter(values, keep)).cast("double")


def _uniformity(s: Column) -> Column:
    """Chi-squared over equal parts of the alphabet, as many as keep five expected in each."""
    n, letters, parts = s["n"], s["letters"], s["parts"]

    def squares(cells: Column) -> Column:
        def term(c: Column) -> Column:
            size = F.ceil((c + 1) * letters / parts) - F.ceil(c * letters / parts)
            expected = n * size / letters
            return F.pow(_count(cells, lambda x: x == c) - expected, F.lit(2.0)) / expected

        return F.aggregate(F.transform(F.sequence(F.lit(0), parts - 1), term), F.lit(0.0), lambda a, x: a + x)

    def upper_tail(chi: Column) -> Column:
        df = (parts - 1).cast("double")
        z = (F.pow(chi / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))  # Wilson-Hilferty
        return _bound(z, lambda z: F.when(z > 0, _two_sided(z) / 2).otherwise(1 - _two_sided(z) / 2))

    return _bound(_bound(F.transform(s["values"], lambda v: F.floor(v * parts / letters)), squares), upper_tail)


def _runs(s: Column) -> Column:
    """Wald-Wolfowitz runs above and below the middle of the alphabet."""
    n = s["n"]

    def tail(x: Column) -> Column:
        a, runs = x["a"], x["runs"]
        mean = 1 + 2 * a * (n - a) / n
        deviation = F.sqrt((mean - 1) * (mean - 2) / (n - 1))
        return F.when((a == 0) | (a == n), F.pow(F.lit(2.0), 1 - n)).otherwise(
            F.when(deviation > 0, _two_sided((runs - mean) / deviation)).otherwise(1.0)
        )

    def counts(high: Column) -> Column:
        changes = F.zip_with(F.slice(high, 1, F.size(high) - 1), F.slice(high, 2, F.size(high) - 1), lambda x, y: x != y)
        return F.struct(_count(high, lambda x: x).alias("a"), (1 + _count(changes, lambda x: x)).alias("runs"))

    return _bound(_bound(F.transform(s["values"], lambda v: v >= s["letters"] / 2), counts), tail)


def _serial(s: Column) -> Column:
    """Correlation of each character's place in the alphabet with the next one's."""
    n = s["n"]

    def tail(off: Column) -> Column:
        squares = F.aggregate(off, F.lit(0.0), lambda a, x: a + x * x)
        products = F.zip_with(F.slice(off, 1, F.size(off) - 1), F.slice(off, 2, F.size(off) - 1), lambda x, y: x * y)
        r = F.aggregate(products, F.lit(0.0), lambda a, x: a + x) / squares
        return F.when(squares > 0, _two_sided((r + 1 / n) * F.sqrt(n))).otherwise(0.0)

    mean = F.aggregate(s["values"], F.lit(0.0), lambda a, v: a + v) / n
    return _bound(_bound(mean, lambda m: F.transform(s["values"], lambda v: v - m)), tail)


def randomness(content: Column) -> Column:
    """Joint p-value (Sidak) that the string is uniform over the alphabet of its inferred encoding."""
    alphabet = (
        F.when(content.rlike("^[0-9a-f]+$"), _HEX_ALPHABET)
        .when(content.rlike("^[0-9A-F]+$"), _UPPER_HEX_ALPHABET)
        .when(content.rlike("^[A-Z2-7]+$"), _BASE32_ALPHABET)
        .otherwise(_BASE64_ALPHABET)
    )
    letters = F.filter(F.split(F.translate(content, "-_", "+/"), ""), lambda c: c != "")  # the URL-safe form is the same encoding

    def measured(a: Column) -> Column:
        n, size = F.length(content).cast("double"), F.length(a)
        return F.struct(
            F.transform(letters, lambda c: (F.instr(a, c) - 1).cast("double")).alias("values"),
            n.alias("n"), size.alias("letters"),
            F.greatest(F.lit(2), F.least(size, F.floor(n / 5))).cast("int").alias("parts"),
        )

    least = _bound(_bound(alphabet, measured), lambda s: F.least(_uniformity(s), _runs(s), _serial(s)))
    return 1 - F.pow(1 - least, F.lit(3.0))


def _length_class(length: Column) -> Column:
    return F.least(F.floor(F.log2(length)), F.lit(12)).cast("int")


def candidates(text: Column, battery: Battery) -> Column:
    """Spans of the candidates with their class of lengths and p-value."""
    return F.transform(
        _found(text, battery.pattern),
        lambda x: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), _length_class(F.length(x["m"])).alias("class"), randomness(x["m"]).alias("p")
        ),
    )


def thresholds(docs: DataFrame, battery: Battery = Battery(), text: str = "text") -> dict[int, float]:
    """For each class of lengths the least p-value to report, from all distinct candidates.

    A string counts once, however often it is copied.  A histogram of at most a
    hundred counts per class, of which there are nine, reaches the driver.
    """
    strings = F.array_distinct(F.regexp_extract_all(whole_text(text), F.lit(battery.pattern), F.lit(0)))
    distinct = docs.select(F.explode(strings).alias("m")).distinct()
    found = distinct.select(_length_class(F.length("m")).alias("class"), randomness(F.col("m")).alias("p"))
    slots = F.least(F.floor(F.col("p") * _P_BINS), F.lit(_P_BINS - 1)).cast("int").alias("bin")
    counts: dict[int, list[int]] = {}
    for kind, place, n in found.groupBy("class", slots).count().collect():
        counts.setdefault(kind, [0] * _P_BINS)[place] += n
    return {kind: _threshold(bins, battery) for kind, bins in counts.items()}


def _threshold(bins: list[int], battery: Battery) -> float:
    random = sum(bins[_P_BINS // 2 :]) * 2
    for place in range(_P_BINS):
        low, reported = place / _P_BINS, sum(bins[place:])
        if low >= battery.floor and reported and reported - random * (1 - low) <= battery.false_share * reported:
            return low
    return 1.0


def secret_spans(docs: DataFrame, battery: Battery = Battery(), text: str = "text") -> Column:
    """All spans of a row's text, sorted: known forms, and random strings that none of those overlaps."""
    content = whole_text(text)
    base = base_spans(content)
    least = thresholds(docs, battery, text)
    limits = F.create_map(*[F.lit(x) for pair in sorted(least.items()) for x in pair]) if least else None
    if limits is None:
        return base

    def all_spans(base: Column) -> Column:
        def apart(c: Column) -> Column:
            return ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))

        passing = F.filter(candidates(content, battery), lambda c: (c["p"] >= F.element_at(limits, c["class"])) & apart(c))
        return F.array_sort(F.concat(base, _spans(passing, 3)))

    return _bound(base, all_spans)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, battery: Battery = Battery(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id and ``found``, the sorted spans (``start``, ``kind``, ``end``).

    Places are code points, ends exclusive; ``kind`` is an index into ``KINDS``.
    Null and empty texts have no spans; repeated rows get equal results; an empty
    table gives an empty one; other columns are ignored.
    """
    return docs.select(F.col(id_column), secret_spans(docs, battery, text).alias("found"))


def redact_secrets(docs: DataFrame, battery: Battery = Battery(), text: str = "text") -> DataFrame:
    """``docs`` with each secret in the text replaced by a mark; overlapping spans are replaced as one.

    Rows without secrets, null texts included, and all other columns stay as they are.
    """
    content = F.col(text)
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(content, acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int"))
        fresh = F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, F.lit(REPLACEMENT)).alias("out"))
        more = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(s["start"] >= acc["at"], fresh).otherwise(more)

    (spans,) = unused(docs, "_spans")
    marked = docs.withColumn(spans, secret_spans(docs, battery, text))
    rest = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(content, acc["at"].cast("int") + 1, F.length(content))))
    return marked.withColumn(text, F.when(F.size(spans) > 0, rest).otherwise(content)).drop(spans)
