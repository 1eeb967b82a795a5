"""Secret scan with DataFrame functions only: three fixed patterns, and character Markov models.

A candidate is a run of ``LEAST`` or more letters, digits and ``+/_=-`` outside the fixed matches. Two
first-order Markov models over characters, one of random strings and one of ordinary identifiers,
give it a log-likelihood ratio; it is a secret if that reaches ``RATIO`` in all and ``PER_STEP`` per
step. Both models are counted from labelled samples: random are the values that the fixed patterns
found and encoded digests (made from the same rows); ordinary are the words of documents in which the
patterns found nothing. All documents are counted, before anything is shuffled.

Positions are code points, end exclusive. Defined results: null and empty texts have no span; long
texts are scanned whole; equal rows give equal spans; without any sample the models are equal and
add nothing; an empty table gives no rows; a column named like an output gives way to it.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cartloom.llm.shared import free_names, without

# Kinds in their order, pattern, group that is measured, least length of it.
KINDS = (
    (
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    ("access", r"(AKIA[A-Z0-9]+)", 1, 16),
    ("hex", r"([0-9a-f]+)", 1, 32),
)
# What a text must have for a pattern to leave a match; found faster than the matches.
_HINTS = (KINDS[0][1], r"AKIA[A-Z0-9]{12}", r"[0-9a-f]{32}")
# One of these is in the lower case of every text with a match of the first pattern.
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
MARKOV = "markov"
LEAST = 16
# Runs are only looked at where they begin; shorter ones make no match.
_LONG_RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}"
RATIO = 10.0
PER_STEP = 0.5
#: Added to the count of every character of a model.
PRIOR = 0.5
#: Weight, in counts, of a character's overall share in each of its steps.
BACKOFF = 10.0
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"

SPAN = "array<struct<start:int,kind:int,end:int>>"


def matches(text: Column, pattern: str, group: int, least: int, kind: int) -> Column:
    """Spans of the leftmost matches whose group (0: the whole match) has ``least`` characters.

    The pieces between matches and the matches themselves give the positions.
    """
    between = F.transform(F.split(text, pattern, -1), F.length)
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    measured = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length) if group else found
    rows = F.zip_with(
        F.slice(between, F.lit(1), F.size(found)),
        F.arrays_zip(found.alias("whole"), measured.alias("part")),
        lambda gap, hit: F.struct(gap.alias("gap"), hit["whole"].alias("whole"), hit["part"].alias("part")),
    )
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def add(state: Column, row: Column) -> Column:
        start = state["at"] + row["gap"]
        end = start + row["whole"]
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        own = F.when(row["part"] >= least, F.array(span)).otherwise(F.array().cast(SPAN))
        return F.struct(end.alias("at"), F.concat(state["spans"], own).alias("spans"))

    return F.aggregate(rows, empty, add, lambda state: state["spans"])


def long_run(text: Column) -> Column:
    """Whether a text has a candidate, or a run that holds one with base spans."""
    return text.rlike(_LONG_RUN)


def hints(text: Column, long: Column | None = None) -> list[Column]:
    """Per kind, whether its pattern leaves a match; what is found fastest is asked first.

    ``long``: where it is known, ``long_run`` of the text, without which there is no match of the third kind.
    """
    # Lower case is made once for all names.
    named = F.exists(F.array(F.lower(text)), lambda low: reduce(Column.__or__, map(low.contains, _NAMES)))
    first = named, text.contains("AKIA"), F.lit(True) if long is None else long
    return [sign & text.rlike(hint) for sign, hint in zip(first, _HINTS)]


def base_spans(text: Column, long: Column | None = None) -> Column:
    """All spans of the fixed patterns by start, then kind."""
    per_kind = []
    for number, ((_, pattern, group, least), hint) in enumerate(zip(KINDS, hints(text, long))):
        own = F.when(hint, matches(text, pattern, group, least, number))
        per_kind.append(F.coalesce(own, F.array().cast(SPAN)))
    return F.array_sort(F.concat(*per_kind))


def candidate_spans(text: Column, base: Column, long: Column | None = None) -> Column:
    """Long runs, and what base spans leave of them: every rest of ``LEAST`` or more."""
    long = long_run(text) if long is None else long
    runs = F.when(long, matches(text, _LONG_RUN, 0, LEAST, len(KINDS)))

    def rests(run: Column) -> Column:
        # Base spans come by their start; what lies between the end of all before and the next start is a rest.
        inside = F.filter(base, lambda span: (span["start"] < run["end"]) & (run["start"] < span["end"]))
        start = F.struct(run["start"].alias("at"), F.array().cast(SPAN).alias("spans"))

        def part(first: Column, end: Column) -> Column:
            own = F.struct(first.alias("start"), run["kind"].alias("kind"), end.alias("end"))
            return F.when(end - first >= LEAST, F.array(own)).otherwise(F.array().cast(SPAN))

        def cut(state: Column, span: Column) -> Column:
            spans = F.concat(state["spans"], part(state["at"], span["start"]))
            return F.struct(F.greatest(state["at"], span["end"]).alias("at"), spans.alias("spans"))

        return F.aggregate(inside, start, cut, lambda state: F.concat(state["spans"], part(state["at"], run["end"])))

    return F.flatten(F.transform(F.coalesce(runs, F.array().cast(SPAN)), rests))


def _pairs(strings: DataFrame) -> DataFrame:
    """Neighbouring characters of (value, random), counted."""
    steps = F.when(F.length("value") > 1, F.sequence(F.lit(1), F.length("value") - 1))
    pairs = strings.select("random", "value", F.explode(steps).alias("at"))
    return pairs.groupBy("random", F.expr("substring(value, at, 2)").alias("pair")).count()


def _as_long_as(least: int):
    return lambda value: F.length(value) >= least


def labelled_strings(docs: DataFrame) -> DataFrame:
    """Labelled strings (value, random) of all documents."""
    none = F.array().cast("array<string>")
    any_hint, values = F.lit(False), none
    for number, (_, pattern, group, least) in enumerate(KINDS):
        any_hint = any_hint | F.col("hinted")[number]
        found = F.regexp_extract_all("text", F.lit(pattern), F.lit(group))
        # Not as a default of the function: Spark would take a second parameter for the position.
        found = F.filter(found, _as_long_as(least))
        values = F.concat(values, F.when(F.col("hinted")[number], found).otherwise(none))
    texts = docs.select("text", F.array(*hints(F.col("text"))).alias("hinted")).where(F.col("text").isNotNull())
    digest = F.unhex(F.sha2("text", 256))
    made = F.array(F.base64(digest), F.upper(F.sha2("text", 256)), F.sha1("text"))
    words = F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9+/_=-]{4,}"), F.lit(0))
    random, ordinary = F.concat(values, made), F.when(any_hint, none).otherwise(words)
    sides = F.array(
        F.struct(F.lit(True).alias("random"), random.alias("values")),
        F.struct(F.lit(False).alias("random"), ordinary.alias("values")),
    )
    labelled = texts.select(F.explode(sides).alias("side"))
    return labelled.select("side.random", F.explode("side.values").alias("value"))


def train(strings: DataFrame, prior: float = PRIOR) -> list[float]:
    """Log-likelihood ratio of every step, at 128 * first + second character code.

    One count per pair of characters and label goes to the driver: a fixed number at any input size.
    """
    counts = {(row["random"], row["pair"]): row["count"] for row in _pairs(strings).collect()}
    logs = {side: _log_steps({p: n for (of, p), n in counts.items() if of is side}, prior) for side in (True, False)}
    table = [0.0] * (128 * 128)
    for first in ALPHABET:
        for second in ALPHABET:
            table[128 * ord(first) + ord(second)] = logs[True][first + second] - logs[False][first + second]
    return table


def _log_steps(counts: dict[str, int], prior: float) -> dict[str, float]:
    """Log-probability of every step; rare first characters lean on how common the second one is."""
    single = {c: prior + sum(counts.get(first + c, 0) for first in ALPHABET) for c in ALPHABET}
    total = sum(single.values())
    out = {}
    for first in ALPHABET:
        seen = sum(counts.get(first + second, 0) for second in ALPHABET)
        for second in ALPHABET:
            own = counts.get(first + second, 0) + BACKOFF * single[second] / total
            out[first + second] = math.log(own / (seen + BACKOFF))
    return out


def ratio(value: Column, table: list[float]) -> Column:
    """Log-likelihood ratio of a string, random against ordinary."""
    # A folded constant: one array for all rows.
    steps = F.split(F.lit(",".join(f"{score:.5f}" for score in table)), ",").cast("array<double>")
    codes = F.transform(F.split(value, ""), F.ascii)
    pairs = F.zip_with(
        F.slice(codes, F.lit(1), F.size(codes) - 1),
        F.slice(codes, F.lit(2), F.size(codes) - 1),
        lambda first, second: F.get(steps, first * 128 + second),
    )
    return F.aggregate(pairs, F.lit(0.0), lambda total, step: total + F.coalesce(step, F.lit(0.0)))


def scan(docs: DataFrame, table: list[float], base: str = "base", spans: str = "spans") -> DataFrame:
    """All columns of ``docs``, base (fixed patterns) and spans (all): arrays of start, kind, end."""
    text, docs = F.col("text"), without(docs, base, spans)
    runs, long = free_names(docs, "runs", "long")
    marked = docs.withColumn(long, long_run(text))
    based = marked.withColumn(base, F.coalesce(base_spans(text, F.col(long)), F.array().cast(SPAN)))
    candidates = candidate_spans(text, F.col(base), F.col(long))
    found = based.withColumn(runs, F.coalesce(candidates, F.array().cast(SPAN)))

    def secret(run: Column) -> Column:
        value = F.substring(text, run["start"] + 1, run["end"] - run["start"])
        steps = run["end"] - run["start"] - 1
        return F.transform(
            F.array(ratio(value, table)), lambda total: (total >= RATIO) & (total >= PER_STEP * steps)
        )[0]

    return found.withColumn(spans, F.array_sort(F.concat(base, F.filter(runs, secret)))).drop(runs, long)


def span_text(spans: Column) -> Column:
    names = F.array(*[F.lit(name) for name, *_ in KINDS], F.lit(MARKOV))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def redact(docs: DataFrame, table: list[float], mark: str = "<secret>") -> DataFrame:
    """The documents, every span of the text replaced by a mark; overlapping spans are one."""
    base, spans = free_names(docs, "base", "spans")
    scanned = scan(docs, table, base, spans)
    text, found = F.col("text"), F.col(spans)
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        inside = span["start"] < state["at"]
        out = F.when(inside, state["out"]).otherwise(F.concat(state["out"], gap, F.lit(mark)))
        return F.struct(out.alias("out"), F.greatest(state["at"], span["end"]).alias("at"))

    def finish(state: Column) -> Column:
        return F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))

    clean = F.when(F.size(found) > 0, F.aggregate(found, start, step, finish)).otherwise(text)
    out = scanned.withColumn("text", clean)
    if "n_chars" in docs.columns:
        out = out.withColumn(
            "n_chars", F.when(F.size(found) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        )
    return out.drop(base, spans)


def report(docs: DataFrame) -> DataFrame:
    """Per document: counts per kind, digest of the base spans, all spans."""
    scanned = scan(docs.select("doc_id", "text"), train(labelled_strings(docs)))

    def of(kind: int) -> Column:
        return F.size(F.filter("base", lambda span: span["kind"] == kind)).cast("long")

    return scanned.select(
        "doc_id",
        *[of(number).alias(f"n_{name}") for number, (name, *_) in enumerate(KINDS)],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )
