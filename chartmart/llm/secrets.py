"""Secrets by fixed patterns and a battery of randomness tests. Built-in functions only.

Patterns find assigned values, access keys and long hexadecimal runs. Beside them, every run of 16 or
more characters of ``A-Za-z0-9+/_=-`` is tested: its encoding is inferred (hexadecimal, base 32,
letters and digits, base 64), and chi-squared uniformity over that alphabet, a runs test about its
middle and serial correlation give a statistic that is small for random strings and grows with the
length of ordinary text.

False discoveries are controlled against the corpus itself. Runs of letters with no capital after
the first are ordinary words; a tested run's p-value is the share of such words, no longer than its
length band, that look at least as random. Within each length band the Benjamini-Hochberg rule picks
the largest statistic at which the expected share of false finds stays below ``ALPHA``. Shorter words
only make the p-value larger, so rare long words do not weaken the control. Both are counted over all
documents, in bins of the statistic; the table of bins has a fixed size.

Defined cases: null and empty texts have no spans; tested runs need a letter and a digit and never
overlap pattern spans; without ordinary words nothing is added; equal texts have equal spans; columns
of the input are kept as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartmart.llm.common import let

ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
# Shorter runs fail, and a run that fails holds no shorter one that passes.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
MIN_VALUE = 6
KINDS = ("assign", "access", "hex", "random")

RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}"
BANDS = (16, 20, 24, 32, 48, 80)  # lower ends of the length bands
ALPHA = 0.01
BIN, BINS = 0.25, 400
MASK = "[SECRET]"
CHUNK = 1024  # code points of a text cut at once

_NONE = "array<struct<start:int,end:int,kind:int>>"


def _running(values: Column, join) -> Column:
    """Running results of ``join`` (associative, 0 neutral) over an array of integers.

    Each round joins every value with the one twice as far before it, so an array of n costs
    n log n steps; appending to an array copies it, which costs n squared.
    """
    far = F.array(*[F.lit(2**k) for k in range(31)])
    before = lambda xs, k: F.concat(
        F.array_repeat(F.lit(0), k), F.slice(xs, F.lit(1), F.size(xs) - k)
    )
    return let(
        values,
        lambda xs: F.aggregate(
            F.filter(far, lambda k: k < F.size(xs)),
            xs,
            lambda ys, k: F.zip_with(ys, before(ys, k), join),
        ),
    )


def _further(x: Column, y: Column) -> Column:
    return F.greatest(x, y)


def _located(text: Column, pattern: str) -> Column:
    """Matches with their code point positions: (start, end, match)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    lengths = lambda m: F.zip_with(
        m,
        F.slice(between, F.lit(1), F.size(m)),
        lambda x, y: F.char_length(x) + F.char_length(y),
    )
    placed = lambda x, end: F.struct(
        (end - F.char_length(x)).alias("start"), end.alias("end"), x.alias("m")
    )
    return let(
        found, lambda m: F.zip_with(m, _running(lengths(m), lambda x, y: x + y), placed)
    )


def _spans(text: Column, pattern: str, kind: int, keep=None) -> Column:
    found = _located(text, pattern)
    if keep is not None:
        found = F.filter(found, keep)
    spans = F.transform(
        found, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(kind).alias("kind"))
    )
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_NONE))


def base_spans(text: Column) -> Column:
    """Pattern spans by start, then kind as listed."""
    value = lambda x: F.char_length(F.regexp_extract(x["m"], ASSIGN, 1)) >= MIN_VALUE
    return F.array_sort(
        F.concat(
            _spans(text, ASSIGN, 0, value), _spans(text, ACCESS, 1), _spans(text, HEX, 2)
        )
    )


def _code(c: Column) -> Column:
    """Place of a character in 0-9 A-Z a-z + /, with - and _ for the last two, = after them."""
    return (
        F.when(c < 43, 64)
        .when(c == 43, 62)
        .when(c == 45, 62)
        .when(c == 47, 63)
        .when(c <= 57, c - 48)
        .when(c == 61, 64)
        .when(c <= 90, c - 55)
        .when(c == 95, 63)
        .otherwise(c - 61)
    )


def _size_of_alphabet(run: Column) -> Column:
    """Inferred encoding by its alphabet: 16, 32, 62 or 64 characters."""
    return (
        F.when(run.rlike("^([0-9a-f]+|[0-9A-F]+)$"), 16)
        .when(run.rlike("^[A-Z2-7]+=*$"), 32)
        .when(run.rlike("^[A-Za-z0-9]+$"), 62)
        .otherwise(64)
    )


def _place(c: Column, k: Column) -> Column:
    """Place of a character code in its alphabet."""
    lower_hex = F.when(c >= 36, c - 26).otherwise(c)
    base32 = F.when(c >= 10, c - 10).otherwise(c + 24)
    return F.when(k == 16, lower_hex).when(k == 32, base32).otherwise(c)


def statistic(run: Column) -> Column:
    """Sum of squared deviations from randomness: uniformity (excess only), runs, correlation."""
    chars = F.array_remove(F.split(run, ""), "")
    places = lambda k: F.transform(chars, lambda c: _place(_code(F.ascii(c)), k))
    squares = lambda xs: F.aggregate(  # noqa: E731  sum of squared counts
        F.sort_array(xs),
        F.struct(F.lit(-1).alias("x"), F.lit(0).alias("run"), F.lit(0.0).alias("sum")),
        lambda s, x: let(
            F.when(x == s["x"], s["run"] + 1).otherwise(1),
            lambda r: F.struct(x.alias("x"), r.alias("run"), (s["sum"] + 2.0 * r - 1).alias("sum")),
        ),
        lambda s: s["sum"],
    )
    real = lambda v: F.lit(float(v))
    sums = lambda xs, half: F.aggregate(
        xs,
        F.struct(
            real(-1).alias("x"),
            real(0).alias("runs"),
            real(0).alias("high"),
            real(0).alias("sx"),
            real(0).alias("sxx"),
            real(0).alias("sxy"),
        ),
        lambda s, x: F.struct(
            x.cast("double").alias("x"),
            (
                s["runs"] + F.when((s["x"] >= 0) & ((s["x"] >= half) == (x >= half)), 0.0).otherwise(1.0)
            ).alias("runs"),
            (s["high"] + (x >= half).cast("double")).alias("high"),
            (s["sx"] + x).alias("sx"),
            (s["sxx"] + x.cast("double") * x).alias("sxx"),
            (s["sxy"] + F.greatest(s["x"], real(0)) * x).alias("sxy"),
        ),
    )

    def combined(xs: Column, k: Column) -> Column:
        n = F.size(xs).cast("double")
        chi = (squares(xs) * k / n - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)

        def rest(s: Column) -> Column:
            high, low = s["high"], n - s["high"]
            mean = 2 * high * low / n + 1
            spread = (mean - 1) * (mean - 2) / (n - 1)
            runs = F.when(spread > 0, (s["runs"] - mean) * (s["runs"] - mean) / spread).otherwise(n)
            mu = s["sx"] / n
            first, last = F.get(xs, 0), s["x"]
            cross = s["sxy"] - mu * (2 * s["sx"] - first - last) + (n - 1) * mu * mu
            around = s["sxx"] - n * mu * mu
            serial = F.when(around > 0, cross * cross / (around * around) * n).otherwise(n)
            over = F.greatest(chi, real(0))
            return over * over + runs + serial

        return let(sums(xs, k / 2), rest)

    return let(_size_of_alphabet(run), lambda k: let(places(k), lambda xs: combined(xs, k)))


def _apart(runs: Column, base: Column) -> Column:
    """The runs that overlap no span: those that no span beginning before their end reaches into.

    Spans by start and runs by end are sorted together; the furthest end of a span so far decides.
    """
    none = F.lit("")
    events = F.concat(
        F.transform(
            runs,
            lambda x: F.struct(
                x["end"].alias("at"), F.lit(0).alias("reach"), x["start"].alias("start"), x["m"].alias("m")
            ),
        ),
        F.transform(
            base,
            lambda x: F.struct(
                x["start"].alias("at"), x["end"].alias("reach"), F.lit(-1).alias("start"), none.alias("m")
            ),
        ),
    )
    free = lambda es: F.filter(
        F.zip_with(
            es,
            _running(F.transform(es, lambda e: e["reach"]), _further),
            lambda e, furthest: F.when(
                (e["start"] >= 0) & (furthest <= e["start"]),
                F.struct(e["start"].alias("start"), e["at"].alias("end"), e["m"].alias("m")),
            ),
        ),
        lambda x: x.isNotNull(),
    )
    return let(F.array_sort(events), free)


def tested_runs(text: Column, base: Column) -> Column:
    """Runs outside pattern spans: (start, end, band, statistic, word), word for ordinary words."""
    kinds = lambda x: x["m"].rlike("^[A-Za-z][a-z]+$") | x["m"].rlike(
        "^(?=.*[0-9])(?=.*[A-Za-z])"
    )
    # The optimiser may put the spans' own expression in place of ``base``: it must stand once.
    runs = F.filter(_located(text, RUN), kinds)
    located = let(base, lambda bs: F.when(F.size(bs) == 0, runs).otherwise(_apart(runs, bs)))
    band = lambda n: sum(((n >= b).cast("int") for b in BANDS[1:]), F.lit(0))
    tested = F.transform(
        located,
        lambda x: F.struct(
            x["start"].alias("start"),
            x["end"].alias("end"),
            band(x["end"] - x["start"]).alias("band"),
            F.least(F.floor(statistic(x["m"]) / BIN), F.lit(BINS - 1)).cast("int").alias("bin"),
            x["m"].rlike("^[A-Za-z][a-z]+$").alias("word"),
        ),
    )
    kind = "array<struct<start:int,end:int,band:int,bin:int,word:boolean>>"
    return F.when(text.rlike(RUN), tested).otherwise(F.array().cast(kind))


def with_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``_row`` with the input's columns, ``_text``, ``_base`` spans and tested ``_runs``."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    plain = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    held = docs.select(row.alias("_row"), plain.alias("_text"))
    held = held.withColumn("_base", base_spans(F.col("_text")))
    return held.withColumn("_runs", tested_runs(F.col("_text"), F.col("_base")))


def limits(runs: DataFrame) -> dict[int, int]:
    """Largest bin of the statistic that still counts as random, per length band."""
    counts = (
        runs.select(F.explode("_runs").alias("r"))
        .groupBy("r.band", "r.bin")
        .agg(F.count_if("r.word").alias("words"), F.count_if(~F.col("r.word")).alias("tested"))
    )
    # At most len(BANDS) x BINS rows from here on.
    grid = (
        counts.sparkSession.range(len(BANDS) * BINS)
        .select((F.col("id") / BINS).cast("int").alias("band"), (F.col("id") % BINS).alias("bin"))
        .join(counts, ["band", "bin"], "left")
        .na.fill(0)
    )
    shorter = Window.partitionBy("bin").orderBy("band")
    upto = Window.partitionBy("band").orderBy("bin")
    own = Window.partitionBy("band")
    grid = grid.withColumn("words", F.sum("words").over(shorter))
    p = (1 + F.sum("words").over(upto)) / (1 + F.sum("words").over(own))
    share = F.sum("tested").over(upto) / F.sum("tested").over(own)
    good = grid.select("band", "bin", "tested", p.alias("p"), share.alias("share"))
    good = good.where((F.col("tested") > 0) & (F.col("p") <= ALPHA * F.col("share")))
    return {r["band"]: r["bin"] for r in good.groupBy("band").agg(F.max("bin").alias("bin")).collect()}


def all_spans(base: Column, runs: Column, limit: dict[int, int]) -> Column:
    """Pattern spans and accepted runs by start, then kind."""
    most = F.lit(-1)
    passes = lambda r: ~r["word"] & (r["bin"] <= _by_band(r["band"], limit, most))
    added = F.transform(
        F.filter(runs, passes),
        lambda r: F.struct(
            r["start"].alias("start"), r["end"].alias("end"), F.lit(KINDS.index("random")).alias("kind")
        ),
    )
    return F.array_sort(F.concat(base, added))


def _by_band(band: Column, limit: dict[int, int], otherwise: Column) -> Column:
    out = otherwise
    for b, value in limit.items():
        out = F.when(band == b, F.lit(value)).otherwise(out)
    return out


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """``_row``, ``_text``, pattern spans ``_base`` and all ``_spans`` of every document."""
    held = with_runs(docs, text)
    limit = limits(held)
    return held.withColumn("_spans", all_spans(F.col("_base"), F.col("_runs"), limit))


def written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
        ),
        ",",
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by ``MASK``.

    A substring walks its text from the start, so pieces are cut from the chunks they lie in.
    """
    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))

    def cut(cs: Column, start: Column, end: Column) -> Column:
        first = F.floor(start / CHUNK).cast("int")
        held = F.slice(cs, first + 1, F.ceil(end / CHUNK).cast("int") - first)
        piece = F.substring(F.array_join(held, ""), start - first * CHUNK + 1, end - start)
        return F.when(start < end, piece).otherwise("")

    def pieces(cs: Column, xs: Column, reach: Column) -> Column:
        # ``reach``: the furthest end so far, after a 0 for the start of the text.
        put = F.zip_with(
            xs,
            F.slice(reach, F.lit(1), F.size(xs)),
            lambda x, at: F.when(
                x["start"] >= at, F.concat(cut(cs, at, x["start"]), F.lit(MASK))
            ).otherwise(""),
        )
        rest = cut(cs, F.element_at(reach, -1), F.char_length(text))
        return F.concat(F.array_join(put, ""), rest)

    whole = lambda xs: F.concat(
        F.array(F.lit(0)), _running(F.transform(xs, lambda x: x["end"]), _further)
    )
    changed = let(spans, lambda xs: let(chunks, lambda cs: let(whole(xs), lambda r: pieces(cs, xs, r))))
    return F.when(F.size(spans) == 0, text).otherwise(changed)


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with their secrets masked; a null text stays null, ``n_chars`` follows."""
    found = find(docs, text)
    new = F.when(F.col(f"_row.`{text}`").isNull(), None).otherwise(
        masked(F.col("_text"), F.col("_spans"))
    )
    found = found.withColumn("_new", F.when(F.size("_spans") > 0, new).otherwise(F.col(f"_row.`{text}`")))
    out = []
    for name in docs.columns:
        column = F.col(f"_row.`{name}`")
        if name == text:
            column = F.col("_new")
        elif name == "n_chars":
            kind = docs.schema[name].dataType
            column = F.when(F.size("_spans") > 0, F.char_length("_new").cast(kind)).otherwise(column)
        out.append(column.alias(name))
    return found.select(*out)
