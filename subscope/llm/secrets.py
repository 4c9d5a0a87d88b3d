"""Secrets in whole texts: fixed patterns, and strings that look random.

Everything here is DataFrame and SQL functions. Three patterns give the base spans. The
method compares two character Markov models: one counts neighbouring characters of the
base matches' secret parts, the other those of all other long identifiers. A long
identifier whose log-likelihood ratio exceeds the prior odds is a span of kind "random",
unless a base span overlaps it. The models are two tables of pair counts over a fixed
alphabet, so what reaches the driver has a fixed size.

Positions come from the pieces between matches: a match starts after all pieces and
matches before it. One pass over the texts writes matches and candidates, without the
texts; counting and scoring read that table.

Defined cases: a NULL text is empty; NULL ids are returned as NULL; repeated rows are
scanned one by one; an empty table gives no rows; without any base match the model of
random strings is uniform. Extra columns are ignored.
"""

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import plain
from . import common

# Fixed values of the base rules.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
LEAST_ASSIGNED = 8
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"(?<![\p{L}\p{N}])[A-Za-z0-9+/_=-]{16,}+(?![\p{L}\p{N}])"
SMOOTHING = 0.5
PRIOR_ODDS = 1e6  # ordinary identifiers for each random one, before looking at it

CHUNK = 4096  # characters of a text's pieces when parts of it are replaced
HALVINGS = 31  # of a search in an array: any that fits into memory

SPAN = "struct<start:bigint,end:bigint,text:string>"


def _located(text: Column, pattern: str, present: Column | None = None, group: int = 0) -> Column:
    """All matches of a pattern as structs of start, end and the text of a group."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if present is not None:
        whole = F.when(present, whole).otherwise(F.array().cast("array<string>"))
    shown = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.arrays_zip(whole.alias("m"), shown.alias("g"), F.split(text, pattern, -1).alias("p"))
    empty = F.array().cast(f"array<{SPAN}>")

    def located(parts: Column) -> Column:
        before = running(F.transform(parts, lambda x: F.length(x["p"]) + F.length(x["m"])), lambda a, b: a + b)

        def span(before: Column):
            def show(part: Column, i: Column) -> Column:
                start = before[i] + F.length(part["p"])
                return F.struct(start.alias("start"), (start + F.length(part["m"])).alias("end"), part["g"].alias("text"))

            return show

        return _bound(before, lambda before: F.transform(parts, span(before)))

    # The last piece follows the last match and has none of its own.
    found = _bound(F.slice(parts, 1, F.size(whole)), located)
    return F.when(F.size(whole) > 0, found.cast(f"array<{SPAN}>")).otherwise(empty)


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, combine, levels: int = 2) -> Column:
    """Per item of an array of numbers, none below 0, what all items before it combine to.

    A fold whose state is an array copies it for each item. This is made of folds to one
    number: of the items before in a block, and of all blocks before, for which the same is
    done once more. With blocks of the cube root of n items, n items take about n^(4/3) steps.
    """

    def folded(items: Column) -> Column:
        return F.aggregate(items, F.lit(0), combine)

    def by_block(values: Column, size: Column) -> Column:
        def block(i: Column) -> Column:
            return F.floor(i / size).cast("int")

        totals = F.transform(F.sequence(F.lit(0), block(F.size(values) - 1)), lambda j: folded(F.slice(values, j * size + 1, size)))

        def each(before: Column):
            return lambda _, i: combine(before[block(i)], folded(F.slice(values, block(i) * size + 1, i - block(i) * size)))

        return _bound(running(totals, combine, levels - 1), lambda before: F.transform(values, each(before)))

    def run(values: Column) -> Column:
        few = F.transform(values, lambda _, i: folded(F.slice(values, F.lit(1), i)))
        if levels == 0:
            return few
        size = F.ceil(F.pow(F.size(values), F.lit(1 / (levels + 1)))).cast("int")
        return F.when(F.size(values) <= 8, few).otherwise(_bound(size, lambda size: by_block(values, size)))

    return _bound(values, run)


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and arrays of located matches: assign, access, hex, candidates."""
    df = common.id_and_text(docs, id_col, text_col)
    df = df.withColumn("text", F.coalesce("text", F.lit("")))
    low = F.lower("text")
    keyed = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api")
    text = F.col("text")
    assign = _located(text, ASSIGN, keyed, 2)
    return df.select(
        "doc_id",
        F.filter(assign, lambda s: F.length(s["text"]) >= LEAST_ASSIGNED).alias("assign"),
        _located(text, ACCESS, text.contains("AKIA")).alias("access"),
        _located(text, HEX).alias("hex"),
        _located(text, CANDIDATE).alias("candidates"),
    )


def _meets(spans: Column, span: Column) -> Column:
    """Does one of the spans, which are in order and apart from each other, overlap this one?

    Of those that start before its end the last one ends last; a search by halves finds it.
    """
    powers = F.lit([1 << k for k in reversed(range(HALVINGS))])

    def step(at: Column, power: Column) -> Column:
        further = at + power
        return F.when((further <= F.size(spans)) & (F.get(spans, further - 1)["start"] < span["end"]), further).otherwise(at)

    before = F.aggregate(powers, F.lit(0), step)
    found = (before > 0) & (F.get(spans, before - 1)["end"] > span["start"])
    return (F.size(spans) > 0) & F.coalesce(found, F.lit(False))


def _outside(span: Column) -> Column:
    """Does no base span overlap this one?"""
    meets = [_meets(F.col(k), span) for k in KINDS[:3]]
    return ~(meets[0] | meets[1] | meets[2])


def others(found: DataFrame) -> DataFrame:
    """Candidates that no base span overlaps."""
    return found.withColumn("candidates", F.filter("candidates", _outside))


def _places(text: Column) -> Column:
    """Places of the characters in the alphabet from 1; 0 for all others."""
    return F.transform(F.split(text, ""), lambda c: F.call_function("instr", F.lit(ALPHABET), c))


def _pairs(codes: Column) -> Column:
    """A number for each pair of neighbours."""
    n = len(ALPHABET) + 1
    rest = F.size(codes) - 1
    return F.when(
        rest > 0, F.zip_with(F.slice(codes, 1, rest), F.slice(codes, 2, rest), lambda a, b: a * n + b)
    ).otherwise(F.array().cast("array<int>"))


def pair_counts(texts: DataFrame) -> dict[int, int]:
    """How often each pair of neighbours occurs in the column ``text``; a bounded result."""
    pairs = texts.select(F.explode(_pairs(_places(F.col("text")))).alias("pair"))
    return {r["pair"]: r["n"] for r in pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).collect()}


def log_ratios(random: dict[int, int], ordinary: dict[int, int]) -> list[float]:
    """Per pair: log of the random over the ordinary probability of the second character."""
    n = len(ALPHABET) + 1
    out = [0.0] * (n * n)
    for a in range(n):
        totals = [sum(c.get(a * n + b, 0) for b in range(1, n)) + SMOOTHING * (n - 1) for c in (random, ordinary)]
        for b in range(1, n):
            p, q = ((c.get(a * n + b, 0) + SMOOTHING) / t for c, t in zip((random, ordinary), totals))
            out[a * n + b] = math.log(p / q)
    return out


def train(found: DataFrame) -> list[float]:
    """Both models from all rows: secret parts of base matches against other candidates."""
    parts = F.concat("assign", "access", "hex")
    random = pair_counts(found.select(F.explode(parts).alias("s")).select("s.text"))
    ordinary = pair_counts(found.select(F.explode("candidates").alias("s")).select("s.text"))
    return log_ratios(random, ordinary)


def _likely_random(ratios: list[float], prior_odds: float):
    table = F.lit(ratios)

    def test(span: Column) -> Column:
        gains = F.transform(_pairs(_places(span["text"])), lambda p: F.element_at(table, p + 1))
        return F.aggregate(gains, F.lit(0.0), lambda a, x: a + x) > math.log(prior_odds)

    return test


def _shown(place: int, kind: str) -> Column:
    def show(s: Column) -> Column:
        name = F.concat_ws(":", F.lit(kind), s["start"], s["end"])
        return F.struct(s["start"].alias("start"), F.lit(place).alias("kind"), name.alias("shown"))

    return F.transform(kind, show)


def _listed(kinds) -> Column:
    """All spans as kind:start:end by start, then kind as listed."""
    spans = F.array_sort(F.concat(*(_shown(i, k) for i, k in enumerate(kinds))))
    return F.concat_ws(",", F.transform(spans, lambda s: s["shown"]))


def spans(docs: DataFrame, prior_odds: float = PRIOR_ODDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with arrays of located matches by kind."""
    found = common.checkpointed(others(scanned(docs, id_col, text_col)), "secret-matches")
    random = F.filter("candidates", _likely_random(train(found), prior_odds))
    return found.select("doc_id", *KINDS[:3], random.alias("random"))


MASK = "[SECRET]"


def masked(docs: DataFrame, prior_odds: float = PRIOR_ODDS, mask: str = MASK) -> DataFrame:
    """The documents with the secret part of every span replaced, all other columns kept.

    The models come from a first pass over all texts; the second one finds the spans again
    beside the text, so that no text is shuffled. A column n_chars is counted anew.
    """
    ratios = train(common.checkpointed(others(scanned(docs)), "secret-matches"))
    arrays = common.fresh_names(docs, ["secret_spans"])[0]
    found = _found_in(F.coalesce(plain("text").cast("string"), F.lit("")), ratios, prior_odds)
    df = docs.withColumn(arrays, found)
    text = F.when(F.size(plain(arrays)) > 0, _replaced(plain("text"), plain(arrays), mask)).otherwise(plain("text"))
    df = df.withColumn("text", text)
    if "n_chars" in docs.columns:
        count = F.when(F.size(plain(arrays)) > 0, F.length(plain("text"))).otherwise(plain("n_chars"))
        df = df.withColumn("n_chars", count.cast(docs.schema["n_chars"].dataType))
    return df.select(*map(plain, docs.columns))


def _found_in(text: Column, ratios: list[float], prior_odds: float) -> Column:
    """Start and end of all secret parts of a text, by start; base parts may overlap."""
    low = F.lower(text)
    keyed = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api")
    assign = F.filter(_located(text, ASSIGN, keyed, 2), lambda s: F.length(s["text"]) >= LEAST_ASSIGNED)
    base = F.struct(assign.alias("assign"), _located(text, ACCESS, text.contains("AKIA")).alias("access"), _located(text, HEX).alias("hex"))
    test = _likely_random(ratios, prior_odds)

    def parts(base: Column) -> Column:
        def added(span: Column) -> Column:
            meets = [_meets(base[k], span) for k in KINDS[:3]]
            return ~(meets[0] | meets[1] | meets[2]) & test(span)

        every = F.concat(*(base[k] for k in KINDS[:3]), F.filter(_located(text, CANDIDATE), added))
        return F.transform(every, lambda s: F.struct((s["end"] - F.length(s["text"])).alias("start"), s["end"].alias("end")))

    return F.array_sort(_bound(base, parts))


def _replaced(text: Column, parts: Column, mask: str) -> Column:
    """The text with a mask in place of each part. Characters are taken from pieces of the
    text, as a character far into a text is slow to find."""
    # Pieces with a number of characters each; "." is any character here.
    cut = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % CHUNK), F.lit(0))

    def replaced(pieces: Column) -> Column:
        def between(start: Column, end: Column) -> Column:
            first = F.floor(start / CHUNK)
            own = F.array_join(F.slice(pieces, (first + 1).cast("int"), (F.floor(end / CHUNK) - first + 1).cast("int")), "")
            return F.substring(own, (start - first * CHUNK + 1).cast("int"), (end - start).cast("int"))

        def masked_parts(covered: Column) -> Column:
            def show(part: Column, i: Column) -> Column:
                return F.when(part["start"] >= covered[i], F.concat(between(covered[i], part["start"]), F.lit(mask))).otherwise("")

            return F.transform(parts, show)

        # How far the parts before each one reach.
        ends = F.transform(parts, lambda s: s["end"].cast("int"))
        shown = F.array_join(_bound(running(ends, lambda a, b: F.greatest(a, b)), masked_parts), "")
        return F.concat(shown, between(F.array_max(ends), F.length(text)))

    return _bound(cut, replaced)


def digests(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(_listed(KINDS[:3]), 256).alias("base_sha256"),
        _listed(KINDS).alias("spans"),
        F.size("random").cast("long").alias("n_random"),
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spans(common.table(spark, sf_dir, "documents")))
