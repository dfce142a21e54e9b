"""Quality rules: every rule is evaluated once into a bitmask; policies and ablations only read bits.

Everything is Column expressions over one row, so a document never leaves its task and nothing is shuffled but the
mask counts of an ablation. Defined cases: a null or blank text has no words (all measurements 0); ``doc_id`` may be
null or repeated (each row is judged for itself); further columns are ignored; an empty table gives no rows.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.common import let, words

WINDOW = 5
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``failed``, SQL over the measurements, is true."""
    name: str
    failed: str


# Bit i of a ledger is rule i; new rules are only ever appended.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("symbols", "5 * n_symbols > n_words"),
    Rule("repeated_lines", "n_lines >= 4 AND 2 * n_dup_lines > n_lines"),
    Rule("no_lower_case", "10 * n_lower < 3 * word_chars"),
)
# Versioned policies: a document stays when it fails none of the named rules.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "short_words", "long_words", "symbols"),
    "v2": tuple(rule.name for rule in RULES),
}


def repeat_words(found: Column, window: int = WINDOW) -> Column:
    """Words inside a window of ``window`` words that occurs twice or more, the first occurrence included.

    Windows are compared by 96 hash bits (two hash functions over the words one by one).
    """
    def covered(places):
        start = F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last"))
        return F.aggregate(places, start, lambda a, p: F.struct(
            (a["n"] + F.least(F.lit(window), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])

    def repeated(ordered):
        def twin(i):
            here, before, after = (F.get(ordered, i + d) for d in (0, -1, 1))
            same = lambda x: F.coalesce((x["h"] == here["h"]) & (x["g"] == here["g"]), F.lit(False))
            return same(before) | same(after)
        at = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), twin)
        return F.when(F.size(at) == 0, 0).otherwise(
            covered(F.sort_array(F.transform(at, lambda i: F.get(ordered, i)["p"]))))

    def count(w):
        windows = F.sequence(F.lit(1), F.size(w) - (window - 1))
        keys = F.transform(windows, lambda i: F.xxhash64(F.slice(w, i, window)))
        # Most texts repeat nothing; only the others are sorted.
        return let(keys, lambda k: F.when(F.size(F.array_distinct(k)) == F.size(k), 0).otherwise(let(
            F.sort_array(F.transform(windows, lambda i: F.struct(
                F.get(k, i - 1).alias("h"), F.hash(F.slice(w, i, window)).alias("g"), (i - 1).alias("p")))),
            repeated)))

    return F.when(F.size(found) <= window, 0).otherwise(count(found))


def measurements(text: Column) -> Column:
    """One struct with everything the rules read, from one pass over the text's words and lines."""
    text = F.coalesce(text, F.lit(""))
    kept = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(F.struct(words(text).alias("w"), lines.alias("l")), lambda x: F.struct(
        F.size(x["w"]).cast("long").alias("n_words"),
        (F.length(text) - kept(" \t\n\x0b\f\r")).cast("long").alias("word_chars"),
        kept(SYMBOLS).cast("long").alias("n_symbols"),
        F.size(x["l"]).cast("long").alias("n_lines"),
        (F.size(x["l"]) - F.size(F.array_distinct(x["l"]))).cast("long").alias("n_dup_lines"),
        repeat_words(x["w"]).cast("long").alias("n_repeat_words"),
        F.length(F.regexp_replace(text, r"\P{Ll}+", "")).cast("long").alias("n_lower")))


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the measurements and ``failures``: bit i is set where rule i fails."""
    measured = docs.select("doc_id", F.inline(F.array(measurements(F.col("text")))))
    bits = [F.when(F.expr(rule.failed), 1 << i).otherwise(0).cast("long") for i, rule in enumerate(rules)]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured.withColumn("failures", total)


def mask(policy: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    return sum(1 << i for i, rule in enumerate(rules) if rule.name in policy)


def passes(policy: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> Column:
    """True where a ledger row fails none of the policy's rules."""
    return F.col("failures").bitwiseAND(F.lit(mask(policy, rules)).cast("long")) == 0


def ablations(book: DataFrame, policies: dict[str, tuple[str, ...]] = POLICIES,
              rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per policy and rule: rows the rule fails, rows only it rejects, and rows kept with and without the rule.

    Rows are first counted per mask (map side, at most 2 ** rules groups); texts and measurements are not read again.
    """
    sets = book.groupBy("failures").agg(F.count("*").alias("n"))
    cases = [F.struct(F.lit(version).alias("policy"), F.lit(rule.name).alias("rule"),
                      F.lit(mask(names, rules)).cast("long").alias("m"), F.lit(1 << i).cast("long").alias("bit"))
             for version, names in policies.items() for i, rule in enumerate(rules) if rule.name in names]
    fails = F.col("failures").bitwiseAND(F.col("m"))
    return (sets.select("failures", "n", F.inline(F.array(*cases))).groupBy("policy", "rule").agg(
        F.sum(F.when(fails.bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(fails == F.col("bit"), F.col("n")).otherwise(0)).alias("only_this"),
        F.sum(F.when(fails == 0, F.col("n")).otherwise(0)).alias("kept"))
        .withColumn("kept_without", F.col("kept") + F.col("only_this")))
