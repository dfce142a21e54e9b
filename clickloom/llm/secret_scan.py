"""Secret scans: fixed patterns, and strings that a character Markov model of random strings explains better than one
of ordinary identifiers.

All of it is Column expressions over one row; only the counts of a training run are shuffled (at most one row per label
and pair of characters). Offsets are code points, ends exclusive. The models are log-likelihood ratios per pair of
neighbouring characters, learned from labelled samples; a pair that a class has not shown goes towards the distribution
of both classes, that is towards no evidence. A candidate is a run of key characters; the patterns' spans are cut out of
it, and each piece of 20 or more characters left is a span when its mean ratio per pair is above the threshold. If it is
not, its windows of 20 characters are judged, so that no path or word around a key hides it: those above the threshold,
with what stands around them up to the next separator, are spans.

Defined cases: a null text is empty (and stays null when redacted); other columns pass through; ids may be null or
repeated; samples that are null or shorter than two characters teach nothing, and a model without samples scores 0
everywhere, so it adds no span. The list of a text's spans grows by copying, some seconds at 100,000 spans in one text.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.llm.common import bounded_sample, free_name, let, same_columns

# The characters of candidates; a model has one row and column for each, and pairs with others teach nothing.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"


@dataclass(frozen=True)
class Pattern:
    """A kind of secret: matches of ``regex`` whose group ``group`` has ``least`` code points or more."""
    name: str
    regex: str
    group: int
    least: int


PATTERNS = (
    Pattern("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    # A run is matched whole or not at all, so its least length can stand in the expression.
    Pattern("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Pattern("hex", r"[0-9a-f]{24,}", 0, 24),
)
MARKOV = "markov"
CANDIDATE = Pattern(MARKOV, r"[A-Za-z0-9+/_=-]{20,}", 0, 20)
THRESHOLD = 0.6
RANDOM_SAMPLES = 6000
IDENTIFIER_DOCS = 400
SAMPLE_TASKS = 8
SPAN = "struct<start:int,order:int,kind:string,finish:int>"


@dataclass(frozen=True)
class Model:
    """ratios[n * a + b] is the log-likelihood ratio of character b after a, random against ordinary, by places in
    the alphabet of n characters."""
    ratios: tuple[float, ...]

    def pairs(self, text: Column) -> Column:
        """The ratio of each neighbouring pair of a text of two or more characters."""
        table = F.expr(f"array({', '.join(f'{r:.6f}D' for r in self.ratios)})")
        places = F.transform(F.slice(F.split(text, ""), F.lit(1), F.length(text)), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
        return let(places, lambda p: F.transform(F.sequence(F.lit(0), F.length(text) - 2), lambda i: F.get(
            table, F.get(p, i) * len(ALPHABET) + F.get(p, i + 1))))

    def spans(self, text: Column, threshold: float, order: int) -> Column:
        """The parts of one piece of a candidate that are random, as spans within it."""
        total = lambda values: F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
        least = CANDIDATE.least
        whole = F.array(F.struct(F.lit(0).alias("start"), F.lit(order).alias("order"), F.lit(MARKOV).alias("kind"),
                                 F.length(text).alias("finish")).cast(SPAN))

        def windows(pairs):
            above = F.transform(F.sequence(F.lit(1), F.size(pairs) - least + 2),
                                lambda i: total(F.slice(pairs, i, F.lit(least - 1))) > threshold * (least - 1))
            # x: a character of a window above the threshold; s: another separator; o: another character.
            signs = let(above, lambda a: F.transform(F.split(F.regexp_replace(
                F.regexp_replace(text, "[A-Za-z0-9]", "o"), "[^o]", "s"), ""), lambda c, i: F.when(F.exists(
                    F.slice(a, F.greatest(i - least + 2, F.lit(1)), F.least(i + 1, F.lit(least))), lambda x: x), "x").otherwise(c)))
            return F.when(F.exists(above, lambda x: x), let(F.array_join(signs, ""), lambda mask: matches(
                mask, Pattern(MARKOV, "(?<![xo])o*+x[xo]*+", 0, least), order))).otherwise(F.array().cast(f"array<{SPAN}>"))

        return let(self.pairs(text), lambda pairs: F.when(total(pairs) > threshold * F.size(pairs), whole).otherwise(
            windows(pairs)))


def fit(samples: DataFrame) -> Model:
    """Learn from rows (sample string, label int: 1 random, 0 ordinary). Only pair counts reach the driver."""
    place = lambda i: F.instr(F.lit(ALPHABET), F.substr("sample", i, F.lit(1)))
    pairs = (samples.where(F.length("sample") > 1)
             .select("label", "sample", F.explode(F.sequence(F.lit(1), F.length("sample") - 1)).alias("i"))
             .select("label", place(F.col("i")).alias("a"), place(F.col("i") + 1).alias("b"))
             .where("label IN (0, 1) AND a > 0 AND b > 0"))
    n = len(ALPHABET)
    counts = [[[0.0] * n for _ in range(n)] for _ in range(2)]
    for label, a, b, seen in pairs.groupBy("label", "a", "b").count().collect():
        counts[label][a - 1][b - 1] += seen
    # The distribution of both classes with equal weight stands for n pairs in each row.
    single = [[1 + sum(row[b] for row in table) for b in range(n)] for table in counts]
    prior = [sum(share[b] / sum(share) for share in single) / 2 for b in range(n)]
    chance = lambda row, b: (row[b] + n * prior[b]) / (sum(row) + n)
    return Model(tuple(math.log(chance(counts[1][a], b)) - math.log(chance(counts[0][a], b))
                       for a in range(n) for b in range(n)))


def random_samples(spark: SparkSession, n: int = RANDOM_SAMPLES) -> DataFrame:
    """Random strings in the usual alphabets (base64, hexadecimal, capitals with digits), by digests of numbers."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    body = F.base64(F.unhex(digest))
    kind = F.col("id") % 3
    text = (F.when(kind == 0, F.rtrim(body, F.lit("="))).when(kind == 1, F.substring(digest, 1, 40))
            .otherwise(F.regexp_replace(F.upper(body), "[^A-Z0-9]", "")))
    return spark.range(n).select(text.alias("sample"), F.lit(1).alias("label"))


def number_samples(spark: SparkSession, n: int = RANDOM_SAMPLES) -> DataFrame:
    """Ordinary strings without words: numbers, dates, ranges of dates, rules and borders of tables, by digests of numbers."""
    digits = F.regexp_replace(F.sha2(F.concat(F.lit("n"), F.col("id")), 256), "[a-f]", "")
    day = lambda shift: F.date_add(F.lit("1950-01-01").cast("date"), F.pmod(F.xxhash64("id") + shift, F.lit(36500)).cast("int"))
    part = lambda places: F.element_at(F.array(*[F.lit(c) for c in places]), (F.col("id") / 6 % len(places)).cast("int") + 1)
    dash = F.repeat(part("-=_"), (F.col("id") / 18 % 20).cast("int") + 2)
    mark = part("-/_=+")
    text = (F.when(F.col("id") % 6 == 0, F.substring(digits, 1, 30))
            .when(F.col("id") % 6 == 1, F.concat_ws("_", day(0).cast("string"), day(90).cast("string")))
            .when(F.col("id") % 6 == 2, F.concat_ws("/", F.date_format(day(0), "yyyy/MM/dd"), F.substring(digits, 1, 6)))
            .when(F.col("id") % 6 == 3, F.concat_ws("-", *[F.substring(digits, 1 + 4 * i, 4) for i in range(6)]))
            .when(F.col("id") % 6 == 4, F.concat(F.lit("+"), dash, F.lit("+"), dash, F.lit("+")))
            .otherwise(F.repeat(mark, 30)))
    return spark.range(n).select(text.alias("sample"), F.lit(0).alias("label"))


def identifier_samples(docs: DataFrame, n: int = IDENTIFIER_DOCS) -> DataFrame:
    """Ordinary strings: words of about ``n`` documents (a bounded sample of labelled rows), each joined with the next word
    in snake, camel and path spelling; some of them in capitals, with a number or a date, and single letters repeated; the
    candidate runs of those documents that hold no pattern's span, if they have no mixture of digits and both cases as keys
    have; and numbers, dates and rules."""
    some = bounded_sample(docs.select("doc_id", "text"), n, "doc_id", "text").repartition(SAMPLE_TASKS)
    found = F.array_distinct(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"\b[A-Za-z]{2,}\b"), F.lit(0)))
    second = lambda f, i: F.coalesce(F.get(f, i + 1), F.lit(""))
    joined = let(found, lambda f: F.transform(f, lambda w, i: F.concat(
        w, F.element_at(F.array(F.lit("_"), F.lit("-"), F.lit("/"), F.lit("")), i % 4 + 1),
        F.when(i % 4 == 3, F.initcap(second(f, i))).otherwise(second(f, i)))))
    number = lambda w: F.abs(F.xxhash64(w) % 3000).cast("string")
    more = let(found, lambda f: F.transform(f, lambda w, i: F.when(i % 16 == 0, F.concat_ws("_", F.upper(w), F.upper(second(f, i))))
               .when(i % 16 == 4, F.concat_ws("-", w, number(w), second(f, i))).when(i % 16 == 8, F.concat(w, number(w)))
               .when(i % 16 == 12, F.concat_ws("/", number(w), w, number(second(f, i)), second(f, i)))
               .when(i % 32 == 15, F.repeat(F.substr(w, i % F.length(w) + 1, F.lit(1)), F.lit(24)))))
    text = F.coalesce("text", F.lit(""))
    clean = F.when(F.size(pattern_spans(text)) == 0, F.regexp_extract_all(text, F.lit(CANDIDATE.regex), F.lit(0)))
    runs = F.filter(F.coalesce(clean, F.array().cast("array<string>")), lambda r: ~(
        F.regexp_like(r, F.lit("[0-9]")) & F.regexp_like(r, F.lit("[A-Z]")) & F.regexp_like(r, F.lit("[a-z]"))))
    samples = F.concat(joined, F.filter(more, lambda x: x.isNotNull()), F.array_distinct(runs))
    return some.select(F.explode(samples).alias("sample"), F.lit(0).alias("label")).unionByName(
        number_samples(docs.sparkSession))


def matches(text: Column, pattern: Pattern, order: int) -> Column:
    """Spans (start, order, kind, finish) of the leftmost non-overlapping matches, those too short dropped."""
    whole = F.regexp_extract_all(text, F.lit(pattern.regex), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(pattern.regex), F.lit(pattern.group)) if pattern.group else whole
    none = F.lit(None).cast(f"array<{SPAN}>")

    def located(found):
        gaps = F.split(text, pattern.regex, -1)
        parts = F.arrays_zip(F.transform(found["w"], lambda x: F.length(x)).alias("size"),
                             F.transform(found["m"], lambda x: F.length(x)).alias("rest"),
                             F.transform(F.slice(gaps, F.lit(1), F.size(found["w"])), lambda x: F.length(x)).alias("gap"))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))
        def step(a, p):
            begin = a["at"] + p["gap"]
            here = F.struct(begin.alias("start"), F.lit(order).alias("order"), F.lit(pattern.name).alias("kind"),
                            (begin + p["size"]).alias("finish")).cast(SPAN)
            return F.struct((begin + p["size"]).alias("at"), F.when(
                p["rest"] >= pattern.least, F.concat(a["spans"], F.array(here))).otherwise(a["spans"]).alias("spans"))
        return F.aggregate(parts, start, step, lambda a: a["spans"])

    # Texts without a match that is long enough, nearly all, are not cut.
    return let(F.struct(whole.alias("w"), measured.alias("m")), lambda found: F.coalesce(F.when(
        F.exists(found["m"], lambda m: F.length(m) >= pattern.least), located(found)), F.coalesce(
            none, F.array().cast(f"array<{SPAN}>"))))


def pattern_spans(text: Column) -> Column:
    return F.flatten(F.array(*[matches(text, p, i) for i, p in enumerate(PATTERNS)]))


def free_pieces(candidate: Column, base: Column) -> Column:
    """What the spans ``base`` leave of a candidate: pieces (start, finish) that are long enough."""
    kind = "struct<start:int,finish:int>"
    piece = lambda a, b: F.when(b - a >= CANDIDATE.least, F.array(F.struct(a.alias("start"), b.alias("finish")).cast(kind))
                                ).otherwise(F.array().cast(f"array<{kind}>"))
    cuts = F.filter(F.sort_array(base), lambda b: (b["start"] < candidate["finish"]) & (candidate["start"] < b["finish"]))
    start = F.struct(candidate["start"].alias("at"), F.array().cast(f"array<{kind}>").alias("done"))
    return F.aggregate(cuts, start, lambda a, b: F.struct(
        F.greatest(a["at"], b["finish"]).alias("at"), F.concat(a["done"], piece(a["at"], b["start"])).alias("done")),
        lambda a: F.concat(a["done"], piece(a["at"], candidate["finish"])))


def scan(docs: DataFrame, model: Model, threshold: float = THRESHOLD, column: str = "spans") -> DataFrame:
    """The documents with all their columns and ``column``: all spans (start, order, kind, finish) by start, then kind as
    listed. An older column of that name is replaced."""
    docs = docs.drop(column)
    base, candidates = free_name(docs, "base"), free_name(docs, "candidates")
    text = F.coalesce("text", F.lit(""))
    based = docs.select("*", F.inline(F.array(F.struct(
        pattern_spans(text).alias(base), matches(text, CANDIDATE, len(PATTERNS)).alias(candidates)))))
    pieces = F.flatten(F.transform(candidates, lambda c: free_pieces(c, F.col(base))))
    random = F.flatten(F.transform(pieces, lambda c: let(
        model.spans(F.substr(text, c["start"] + 1, c["finish"] - c["start"]), threshold, len(PATTERNS)),
        lambda found: F.transform(found, lambda s: F.struct(
            (s["start"] + c["start"]).alias("start"), s["order"].alias("order"), s["kind"].alias("kind"),
            (s["finish"] + c["start"]).alias("finish")).cast(SPAN)))))
    return based.withColumn(column, F.sort_array(F.concat(base, random))).drop(base, candidates)


def told(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["finish"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each maximal run of overlapping spans replaced by ``mark``."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    def step(a, s):
        more = F.concat(a["out"], F.substr(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mark))
        return F.struct(F.when(s["start"] >= a["at"], more).otherwise(a["out"]).alias("out"),
                        F.greatest(a["at"], s["finish"]).alias("at"))
    whole = F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1, F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(whole)


def redact(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with their columns and every secret of ``text`` replaced; ``n_chars``, if there, is counted anew."""
    column = free_name(docs, "spans")
    found = scan(docs, model, threshold, column).withColumn("text", redacted(F.col("text"), F.col(column)))
    if "n_chars" in docs.columns:
        counted = F.when(F.size(column) > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        found = found.withColumn("n_chars", counted.otherwise(F.col("n_chars")))
    return same_columns(found, docs)
