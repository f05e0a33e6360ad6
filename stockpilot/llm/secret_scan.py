"""Secret scan with a battery of randomness tests.

Three plain patterns (assignments, access keys, long hexadecimal runs) always
count.  Beyond them, every run of key-like characters is tested for randomness
in the alphabet it seems to be written in (hexadecimal, letters and digits,
mixed letters, base 62 or 64):

* chi-squared statistic of the characters against a uniform alphabet,
* runs test on characters below and above the middle of the alphabet,
* serial correlation of neighbouring characters.

A run that is too uneven, or too regular, for random characters (Bonferroni over
the three) is no key.  For the rest, each statistic has a p-value against text: the
share of the corpus' own text runs, of the same alphabet and band of length, that come
as near to random characters.  ``1 / (2 sqrt(p))`` is evidence with a mean of one under
text.  A fourth piece of evidence looks at the same properties together: the likelihood
of characters, of changes between digits, lower case, upper case and signs and of
neighbours as random characters, over that under a chain learnt from the corpus' own
runs; it is large for random runs of 20 characters already.  The weighted mean of the
four (``WEIGHTS``) has a mean of one under text however they depend on each other, so
text exceeds r in one run of r at most and its inverse is a p-value.  Random runs hardly
teach what text is: each run counts by the chance that it is text, found in ``ROUNDS``
rounds from English letters on.  Parts of a run between signs are tested too, for keys
inside of paths and names; of overlapping finds the one with the highest ratio is
reported.  Benjamini-Hochberg control within bands of length picks the runs reported.

Spans in texts come from splitting at a pattern and adding up the lengths of the
pieces.  Everything is DataFrame functions; whole texts are read once, and only
pairs of characters and histograms of the statistics and of p-values (fixed numbers
of rows) are aggregated.

Cases: a null text counts as empty; empty texts and tables have no spans; rows
that repeat a ``doc_id`` are scanned each on their own; further columns pass
through.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpilot.llm.text import staged, text_or_empty

# The patterns of the contract.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_CHARS = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")

MIN_CHARS = 20
RUN = rf"[A-Za-z0-9+/_-]{{{MIN_CHARS},}}"
PART = rf"[A-Za-z0-9]{{{MIN_CHARS},}}"
#: Chance of calling random characters uneven.
ALPHA = 0.001
#: Share of false discoveries among the reported runs.
FDR = 0.01
#: Lower ends of the bands of length.
BANDS = (20, 24, 28, 32, 40, 48, 64, 96, 128, 256)
#: Levels of -log10 p: a tenth each, up to 60.
LEVELS = 600
#: Shares of the ratio, the chi-squared, the runs and the serial test in the evidence.
WEIGHTS = (0.7, 0.1, 0.1, 0.1)
#: Levels of a statistic's -log10 tail: steps of a quarter.
TAIL_LEVELS, TAIL_STEP = 41, 0.25

#: Rounds in which the text's chain is learnt.
ROUNDS = 3
#: Alphabets that a run may be written in.
ALPHABETS = (16, 36, 52, 62, 64)
#: First share of random ones among the mixed runs.
RANDOM_SHARE = 0.01
SYMBOLS = 64
#: Digits, lower case, upper case, signs.
CLASS_OF = (0,) * 10 + (1,) * 26 + (2,) * 26 + (3,) * 2
# Fixed value: letters in a thousand of English text, which teach what a corpus does not.
ENGLISH = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1)
#: What the prior counts for: characters of a class, changes from a class, pairs with a character.
PRIOR_CHARS, PRIOR_CHANGES, PRIOR_PAIRS = 200.0, 50.0, 20.0
PRIOR_STAY = 0.9

ADDED = "struct<start:bigint,kind:int,end:bigint>"
SPAN = "struct<kind:int,start:bigint,end:bigint>"
PROBE = "struct<start:bigint,end:bigint,k:int,n:int,regular:double,tails:array<double>,codes:array<int>,part:boolean>"


def _starts(text: Column, pattern: str, found: Column) -> Column:
    """Where each match begins: lengths of the pieces before it and of the earlier matches."""
    steps = F.zip_with(
        F.slice(F.split(text, pattern, -1), 1, F.size(found)),
        found,
        lambda piece, match: F.struct(F.length(piece).cast("bigint").alias("gap"), F.length(match).cast("bigint").alias("size")),
    )
    empty = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))
    return F.aggregate(
        steps,
        empty,
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["size"]).alias("at"),
            F.concat(
                acc["spans"],
                F.array(F.struct((acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["size"]).alias("end"))),
            ).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )


def _all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def base_spans(text: Column) -> Column:
    """array<struct<kind,start,end>> of the three plain patterns, by start and kind."""
    none = F.array().cast(f"array<{SPAN}>")

    def kind(k: int, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    valued = F.filter(
        F.arrays_zip(_starts(text, ASSIGN, _all(text, ASSIGN)).alias("span"), _all(text, ASSIGN, 2).alias("value")),
        lambda x: F.length(x["value"]) >= ASSIGN_CHARS,
    )
    assign = F.when(text.rlike(ASSIGN), kind(0, F.transform(valued, lambda x: x["span"]))).otherwise(none)
    access = F.when(F.contains(text, F.lit("AKIA")), kind(1, _starts(text, ACCESS, _all(text, ACCESS)))).otherwise(none)
    hexes = F.when(text.rlike(HEX), kind(2, _starts(text, HEX, _all(text, HEX)))).otherwise(none)
    return F.sort_array(F.transform(F.concat(assign, access, hexes), _by_start)).cast("array<struct<start:bigint,kind:int,end:bigint>>")


def _by_start(s: Column) -> Column:
    return F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))


def _tail(z: Column) -> Column:
    """-log10 of the normal tail above z (rational approximation, right for large z)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = z * z / 2 * math.log10(math.e) - F.log10(series / math.sqrt(2 * math.pi))
    below = F.pow(F.lit(10.0), -upper)
    return F.when(z >= 0, upper).otherwise(-F.log10(1 - F.least(below, F.lit(0.5))))


def _two_sided(z: Column) -> Column:
    return F.greatest(_tail(F.abs(z)) - math.log10(2), F.lit(0.0))


def _alphabet(s: Column) -> Column:
    """Size of the alphabet a run seems to be written in; 10 and 26 are no keys."""
    return (
        F.when(s.rlike("^[0-9]+$"), 10)
        .when(s.rlike("^([0-9a-f]+|[0-9A-F]+)$"), 16)
        .when(s.rlike("^([A-Z]?[a-z]+|[A-Z]+)$"), 26)
        .when(s.rlike("^([0-9a-z]+|[0-9A-Z]+)$"), 36)
        .when(s.rlike("^[A-Za-z]+$"), 52)
        .when(s.rlike("^[0-9A-Za-z]+$"), 62)
        .otherwise(64)
    )


def _codes(s: Column) -> Column:
    """Place of each character among all: digits, lower case, upper case, signs."""

    def place(i: Column) -> Column:
        c = F.ascii(F.substring(s, i, F.lit(1)))
        return (
            F.when(c.between(48, 57), c - 48)
            .when(c.between(97, 122), c - 87)
            .when(c.between(65, 90), c - 29)
            .when(c.isin(43, 45), 62)
            .otherwise(63)
        )

    return F.transform(F.sequence(F.lit(1), F.length(s)), place)


def _indexes(codes: Column, k: Column) -> Column:
    """Place of each character in its alphabet."""
    skip = F.when(k.isin(26, 52), 10).otherwise(0)
    return F.transform(codes, lambda c: F.when((k < 52) & c.between(36, 61), c - 26).otherwise(c) - skip)


def _probe(s: Column, span: Column, part: Column) -> Column:
    """The statistics of one run of characters."""
    return F.transform(
        F.transform(F.array(F.struct(_alphabet(s).alias("k"), _codes(s).alias("codes"))), lambda a: F.struct(a["k"], a["codes"], _indexes(a["codes"], a["k"]).alias("x"))),
        lambda a: _statistics(a["k"], a["codes"], a["x"], span, part),
    )[0].cast(PROBE)


def _total(xs: Column, f) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + f(x).cast("double"))


def _statistics(k: Column, codes: Column, x: Column, span: Column, part: Column) -> Column:
    n = F.size(x).cast("double")
    counts = F.transform(F.sequence(F.lit(0), k - 1), lambda j: F.size(F.filter(x, lambda v: v == j)))
    s2 = _total(counts, lambda c: c * c)
    # chi-squared, large values only
    chi = k * s2 / n - n
    z_chi = (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    # runs of characters below and above the middle
    high = F.transform(x, lambda v: (2 * v >= k).cast("int"))
    a = _total(high, lambda v: v)
    b = n - a
    pairs = F.zip_with(F.slice(x, F.lit(1), F.size(x) - 1), F.slice(x, F.lit(2), F.size(x) - 1), lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    runs = 1 + _total(pairs, lambda w: ((2 * w["p"] >= k) != (2 * w["q"] >= k)).cast("int"))
    expected = 1 + 2 * a * b / n
    spread = F.sqrt((expected - 1) * (expected - 2) / (n - 1))
    z_runs = F.when(spread > 0, (runs - expected) / spread).otherwise(F.lit(99.0))
    # correlation of neighbours
    mean = _total(x, lambda v: v) / n
    around = _total(x, lambda v: (v - mean) * (v - mean))
    z_serial = F.when(around > 0, _total(pairs, lambda w: (w["p"] - mean) * (w["q"] - mean)) / around * F.sqrt(n)).otherwise(F.lit(99.0))
    return F.transform(
        F.array(F.array(_tail(z_chi), _two_sided(z_runs), _two_sided(z_serial))),
        lambda tails: F.struct(
            span["start"].alias("start"),
            span["end"].alias("end"),
            k.alias("k"),
            n.cast("int").alias("n"),
            F.array_max(tails).alias("regular"),
            tails.alias("tails"),
            codes.alias("codes"),
            part.alias("part"),
        ),
    )[0]


def probes(text: Column) -> Column:
    """array of statistics, one for each run of key-like characters and for each long part of one."""

    def runs(s: Column, pattern: str, offset: Column, part: bool) -> Column:
        found = _all(s, pattern)
        return F.transform(
            F.arrays_zip(_starts(s, pattern, found).alias("span"), found.alias("run")),
            lambda r: F.struct(
                F.struct((r["span"]["start"] + offset).alias("start"), (r["span"]["end"] + offset).alias("end")).alias("span"), r["run"].alias("run"), F.lit(part).alias("part")
            ),
        )

    def with_parts(r: Column) -> Column:
        parts = F.filter(runs(r["run"], PART, r["span"]["start"], True), lambda p: F.length(p["run"]) < F.length(r["run"]))
        return F.concat(F.array(r), F.when(r["run"].rlike("[+/_-]"), parts).otherwise(F.slice(F.array(r), 1, 0)))

    tested = F.flatten(F.transform(runs(text, RUN, F.lit(0).cast("bigint"), False), with_parts))
    none = F.array().cast(f"array<{PROBE}>")
    return F.when(text.rlike(RUN), F.transform(tested, lambda r: _probe(r["run"], r["span"], r["part"]))).otherwise(none)


def scanned(docs: DataFrame, columns: list[str]) -> DataFrame:
    """row (of ``columns``), base, probes: whole texts are read here, once."""
    text = text_or_empty()
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    return docs.select(row, base_spans(text).alias("base"), probes(text).alias("probes"))


def _chain(pairs: dict[tuple[int, int, bool], float]) -> tuple[list[float], list[float]]:
    """log10 of the chances of a first character, and of each character after each
    other, from counts by (first, second, whether the run is mixed)."""
    own: dict[int, list[int]] = {c: [x for x in range(SYMBOLS) if CLASS_OF[x] == c] for c in range(4)}
    follows = [[0.0] * SYMBOLS for _ in range(SYMBOLS)]
    changes = [[0.0] * 4 for _ in range(4)]
    for (a, b, mixed), n in pairs.items():
        follows[a][b] += n
        if mixed:
            changes[CLASS_OF[a]][CLASS_OF[b]] += n
    seen = [sum(follows[a][b] for a in range(SYMBOLS)) for b in range(SYMBOLS)]
    share = [0.0] * SYMBOLS
    for c, chars in own.items():
        prior = [ENGLISH[i] if c in (1, 2) else 1 for i in range(len(chars))]
        whole = sum(seen[x] for x in chars) + PRIOR_CHARS
        for x, w in zip(chars, prior):
            share[x] = (seen[x] + PRIOR_CHARS * w / sum(prior)) / whole
    into = [sum(changes[c][d] for c in range(4)) + PRIOR_CHANGES / 4 for d in range(4)]
    first = [math.log10(into[CLASS_OF[x]] / sum(into) * share[x]) for x in range(SYMBOLS)]
    after = []
    for a in range(SYMBOLS):
        c = CLASS_OF[a]
        for b in range(SYMBOLS):
            d = CLASS_OF[b]
            change = (changes[c][d] + PRIOR_CHANGES * (PRIOR_STAY if c == d else (1 - PRIOR_STAY) / 3)) / (sum(changes[c]) + PRIOR_CHANGES)
            char = (follows[a][b] + PRIOR_PAIRS * share[b]) / (sum(follows[a][x] for x in own[d]) + PRIOR_PAIRS)
            after.append(math.log10(change * char))
    return first, after


def _numbers(xs: list[float]) -> Column:
    """A constant array, as one literal."""
    return F.split(F.lit(",".join(f"{x:.5f}" for x in xs)), ",").cast("array<double>")


def _steps(codes: Column) -> Column:
    """Each character with the one before it, as one number."""
    size = F.size(codes)
    return F.zip_with(F.slice(codes, F.lit(1), size - 1), F.slice(codes, F.lit(2), size - 1), lambda a, b: a * SYMBOLS + b)


def _mixed(p: Column) -> Column:
    return ~p["k"].isin(10, 26)


class TextModel(NamedTuple):
    """What text is: the chain, and the evidence that a statistic gives, by ``_null_cell``."""

    first: list[float]
    after: list[float]
    evidence: list[float]


def _ratio(p: Column, first: list[float], after: list[float]) -> Column:
    """log10 of how much likelier random characters of its alphabet make a run than text."""
    first, after = _numbers(first), _numbers(after)
    text = F.get(first, p["codes"][0]) + F.aggregate(_steps(p["codes"]), F.lit(0.0), lambda acc, i: acc + F.get(after, i))
    return -p["n"] * F.log10(p["k"].cast("double")) - math.log10(len(ALPHABETS)) - text


def _band(p: Column) -> Column:
    band = F.lit(0)
    for i, low in enumerate(BANDS):
        band = F.when(p["n"] >= low, i).otherwise(band)
    return band


def _null_cell(p: Column, statistic: Column | int) -> Column:
    """Statistic, alphabet and band of length, as one number."""
    alphabet = F.array_position(F.array(*[F.lit(k) for k in ALPHABETS]), p["k"]).cast("int") - 1
    return (statistic * len(ALPHABETS) + alphabet) * len(BANDS) + _band(p)


def _tail_level(tail: Column) -> Column:
    return F.least(F.ceil(tail / TAIL_STEP), F.lit(TAIL_LEVELS - 1)).cast("int")


def text_evidence(weighed: DataFrame) -> list[float]:
    """``1 / (2 sqrt(p))`` for each cell and level: p is the share of the cell's text
    runs whose tail is at most at that level, with one more counted on both sides."""
    p = F.col("p")
    each = weighed.where(_mixed(p)).select(p, "random", F.posexplode(p["tails"]).alias("statistic", "tail"))
    rows = (
        each.select(_null_cell(p, F.col("statistic")).alias("cell"), _tail_level(F.col("tail")).alias("level"), (1 - F.col("random")).alias("weight"))
        .groupBy("cell", "level")
        .agg(F.sum("weight").alias("n"))
        .collect()  # at most 3 x alphabets x bands x levels rows
    )
    seen = {(r["cell"], r["level"]): r["n"] for r in rows}
    evidence = []
    for cell in range(3 * len(ALPHABETS) * len(BANDS)):
        counts = [seen.get((cell, level), 0.0) for level in range(TAIL_LEVELS)]
        below = 1.0
        for count in counts:
            below += count
            evidence.append(0.5 * math.sqrt((sum(counts) + 1) / below))
    return evidence


def text_model(scan: DataFrame) -> TextModel:
    """The chain of the corpus' runs that are text: changes between kinds of characters
    from mixed runs, which are those tested, and characters from all but digits; then
    what the three statistics are like in the mixed ones."""
    p = F.col("p")
    runs = scan.select(F.explode("probes").alias("p")).where(~p["part"] & (p["k"] != 10))
    chain, odds = _chain({}), RANDOM_SHARE / (1 - RANDOM_SHARE)

    def weighed() -> DataFrame:
        random = 1 / (1 + F.pow(F.lit(10.0), F.least(-_ratio(p, *chain), F.lit(300.0))) / odds)
        return runs.select(p, F.when(_testable(p), random).otherwise(0.0).alias("random"))

    for _ in range(ROUNDS):
        step = weighed().select(F.explode(_steps(p["codes"])).alias("step"), _mixed(p).alias("mixed"), (1 - F.col("random")).alias("weight"))
        pairs = step.groupBy("step", "mixed").agg(F.sum("weight").alias("n")).collect()  # at most 2 x 64 x 64 rows
        share, count = weighed().where(_mixed(p)).agg(F.sum("random"), F.count(F.lit(1))).first()
        chain = _chain({(r["step"] // SYMBOLS, r["step"] % SYMBOLS, r["mixed"]): r["n"] for r in pairs})
        share = ((share or 0.0) + RANDOM_SHARE) / (count + 1)
        odds = share / (1 - share)
    return TextModel(*chain, text_evidence(weighed()))


def _level(p: Column, model: TextModel) -> Column:
    """-log10 of the chance that text gives as much evidence, in tenths."""
    found = _numbers(model.evidence)
    mean = WEIGHTS[0] * F.pow(F.lit(10.0), F.least(_ratio(p, model.first, model.after), F.lit(LEVELS / 10 + 1)))
    for i, weight in enumerate(WEIGHTS[1:]):
        mean = mean + weight * F.get(found, _null_cell(p, i) * TAIL_LEVELS + _tail_level(p["tails"][i]))
    return F.greatest(F.least(F.floor(10 * F.log10(mean)), F.lit(LEVELS)), F.lit(0)).cast("int")


def _testable(p: Column) -> Column:
    return _mixed(p) & (p["regular"] <= -math.log10(ALPHA / 3))


def thresholds(scan: DataFrame, model: TextModel, fdr: float) -> dict[int, int]:
    """band -> lowest reported level, by Benjamini-Hochberg within the band."""
    p = F.col("p")
    levels = (
        scan.select(F.explode("probes").alias("p"))
        .where(_mixed(p))
        .select(_band(p).alias("band"), F.when(_testable(p), _level(p, model)).otherwise(0).alias("level"))
        .groupBy("band", "level")
        .count()
        .collect()  # at most bands x levels rows
    )
    found = {}
    for band in {r["band"] for r in levels}:
        own = sorted(((r["level"], r["count"]) for r in levels if r["band"] == band), reverse=True)
        total, above = sum(c for _, c in own), 0
        for level, count in own:
            above += count
            if 10 ** (-level / 10) * total <= fdr * above:
                found[band] = level
    return found


def _added(base: Column, probed: Column, model: TextModel, limits: dict[int, int]) -> Column:
    """The spans that the tests add, outside of the plain ones."""

    def reported(p: Column) -> Column:
        limit = F.lit(None).cast("int")
        for band, level in sorted(limits.items()):
            limit = F.when(_band(p) == band, level).otherwise(limit)
        clear = ~F.exists(base, lambda b: (b["start"] < p["end"]) & (p["start"] < b["end"]))
        return _testable(p) & F.coalesce(_level(p, model) >= limit, F.lit(False)) & clear

    rated = F.transform(
        F.filter(probed, reported),
        lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), p["part"].alias("part"), _ratio(p, model.first, model.after).alias("ratio")),
    )
    # Highest first; a run lies before its parts where both are the same.
    order = F.sort_array(F.transform(rated, lambda r: F.struct((-r["ratio"]).alias("less"), r["part"], r["start"], r["end"])))
    taken = F.aggregate(
        order,
        F.array().cast(f"array<{ADDED}>"),
        lambda acc, r: F.when(F.exists(acc, lambda t: (t["start"] < r["end"]) & (r["start"] < t["end"])), acc).otherwise(
            F.concat(acc, F.array(F.struct(r["start"].alias("start"), F.lit(3).alias("kind"), r["end"].alias("end"))))
        ),
    )
    return F.when(F.size(probed) == 0, F.array().cast(f"array<{ADDED}>")).otherwise(taken)


def secret_scan(docs: DataFrame, fdr: float = FDR, columns: list[str] | None = None) -> DataFrame:
    """row (the input's columns, or ``columns`` of them), base, spans: arrays of (start, kind, end), by start
    then kind; ``spans`` holds the base spans and those that the tests add."""
    scan = staged(scanned(docs, columns or docs.columns), "secret-probes")
    model = text_model(scan)
    limits = thresholds(scan, model, fdr)
    added = _added(F.col("base"), F.col("probes"), model, limits)
    return scan.select("row", "base", F.sort_array(F.concat("base", added)).alias("spans"))


def digest(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redact(docs: DataFrame, mark: str = "[SECRET]", fdr: float = FDR) -> DataFrame:
    """The documents with every found span replaced by ``mark``; ``n_chars`` follows."""
    text = F.col("row.text")
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))
    walked = F.aggregate(
        "spans",
        state,
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(
                s["end"].alias("at"),
                F.concat(acc["parts"], F.array(F.substring(text, acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int")), F.lit(mark))).alias("parts"),
            ),
        ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["parts"].alias("parts"))),
    )
    rest = F.substring(text, F.col("walked.at").cast("int") + 1, F.length(text))
    clean = F.when(F.size("spans") == 0, text).otherwise(F.concat(F.array_join("walked.parts", ""), rest))
    row = F.col("row").withField("text", F.col("clean"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.when(F.size("spans") == 0, F.col("row.n_chars")).otherwise(F.length("clean")).cast(docs.schema["n_chars"].dataType))
    return (
        secret_scan(docs, fdr)
        .withColumn("walked", walked)
        .withColumn("clean", clean)
        .select(row.alias("row"))
        .select("row.*")
    )
