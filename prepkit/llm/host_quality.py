"""Quality rules with host verdicts, in DataFrame expressions only.

Each document is measured (words, symbols, repeated lines, repeated 8-word windows) and the measures are
stored, with the columns asked for; no text is stored. Rule failures are counted per host, where
partial sums take the heat off a host of many rows. Host rates are shrunk towards all hosts by a beta
prior fitted to them by moments, and the verdict on the host (trusted, usual, bad) is joined back to its
documents. A document goes if it fails the base rule, or more of the softer rules than its host is allowed:
one on a trusted host, else none. On a bad host the softer rules have stricter limits. A document that is
within all limits, the strict ones too, stays on any host.

Defined cases: a null or empty text has no words and fails the base rule; a null host is a host of its
own; repeated rows count as often as they occur; without documents there are no hosts. Windows are
compared by 64-bit hashes within one text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepkit.session import pin, small_side, temporary_tables

WORDS = r"[^\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS, REPEAT_WINDOW, MAX_REPEAT_PCT = 20, 8, 30
#: The softer rules: symbols per word, repeated lines per line (in percent), and mean word length.
LIMITS = (20, 30, 2, 16)
#: The same for documents of a bad host.
STRICT_LIMITS = (10, 15, 3, 12)
#: A host whose shrunk rate is under this share of the mean rate is trusted; over this rate it is bad.
TRUSTED_SHARE, BAD_RATE = 0.5, 0.5


def _after(col: str, skip: int) -> Column:
    """The array without its first ``skip`` elements."""
    return F.slice(F.col(col), F.lit(skip + 1), F.size(col))


def measure(docs: DataFrame, text: str = "text", host: str = "source", carried: Sequence[str] = ()) -> DataFrame:
    """The host, the measures and (as struct ``row``) the carried columns of every row."""
    row = F.struct(*(F.col(c) for c in carried)) if carried else F.lit(None)
    df = docs.select(row.alias("row"), F.col(host).alias("host"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    lines = F.filter(F.split("t", "\n"), lambda line: line.rlike(WORDS))
    df = df.select(
        "row", "host", F.regexp_extract_all("t", F.lit(f"({WORDS})")).alias("w"), lines.alias("lines"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    df = df.select(
        "row", "host", "n_symbols",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h1"),
    )
    # Hashes of windows of 2, 4 and 8 words, each made from two of half its size.
    for name, wider, skip in (("h1", "h2", 1), ("h2", "h4", 2), ("h4", "h8", 4)):
        df = df.withColumn(wider, F.zip_with(name, _after(name, skip), lambda a, b: F.xxhash64(a, b))).drop(name)
    n_windows = F.greatest(F.size("h8") - (REPEAT_WINDOW - 1), F.lit(0))
    df = df.withColumn("h8", F.slice("h8", F.lit(1), n_windows))
    df = df.withColumn("again", F.size(F.array_distinct("h8")) < F.size("h8"))
    # Only texts with a repeated window sort theirs, and pair equal neighbours.
    placed = F.array_sort(F.transform("h8", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("placed", F.when(F.col("again"), placed)).drop("h8")
    equal = F.zip_with(
        "placed", _after("placed", 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))
    )
    begins = F.array_sort(F.array_distinct(F.flatten(F.filter(equal, lambda x: x.isNotNull()))))
    df = df.withColumn("begins", begins).drop("placed", "again")
    steps = F.zip_with(
        "begins", _after("begins", 1),
        lambda a, b: F.least(F.lit(REPEAT_WINDOW), F.coalesce(b - a, F.lit(REPEAT_WINDOW))),
    )
    covered = F.coalesce(F.aggregate(steps, F.lit(0), lambda total, x: total + x), F.lit(0)).cast("long")
    return df.select(
        "row", "host", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", covered.alias("n_repeat_words")
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def soft_failures(limits: Sequence[int] = LIMITS) -> Column:
    """How many of the softer rules a document fails."""
    symbols, lines, shortest, longest = limits
    rules = (
        100 * F.col("n_symbols") > symbols * F.col("n_words"),
        100 * F.col("n_dup_lines") > lines * F.col("n_lines"),
        (F.col("word_chars") < shortest * F.col("n_words")) | (F.col("word_chars") > longest * F.col("n_words")),
    )
    return sum((r.cast("int") for r in rules[1:]), rules[0].cast("int"))


def host_verdicts(measures: DataFrame) -> DataFrame:
    """``host, n_docs, n_failed, rate, verdict`` from the measures of all documents.

    Hosts weigh as much as they have documents. The prior has the mean rate, and of the variance between
    rates the part that sampling does not explain.
    """
    failed = (base_failed() | (soft_failures() > 0)).cast("long")
    hosts = measures.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(failed).alias("n_failed"))
    hosts = pin(hosts, "hosts")
    failed, docs, count, squares = hosts.agg(
        F.sum("n_failed"), F.sum("n_docs"), F.count(F.lit(1)), F.sum(F.col("n_failed") ** 2 / F.col("n_docs"))
    ).first()
    mean = failed / docs if docs else 0.0
    spread = squares / docs - mean * mean if docs else 0.0
    between = max(spread - count * mean * (1 - mean) / max(docs or 0, 1), 1e-6)
    strength = max(mean * (1 - mean) / between - 1, 1.0)
    shrunk = (F.col("n_failed") + mean * strength) / (F.col("n_docs") + strength)
    verdict = F.when(shrunk > BAD_RATE, "bad").when(shrunk < TRUSTED_SHARE * mean, "trusted").otherwise("usual")
    return hosts.withColumn("rate", shrunk).withColumn("verdict", verdict)


def _judged(measures: DataFrame, verdicts: DataFrame) -> DataFrame:
    hosts = small_side(verdicts.select(F.col("host").alias("h"), "verdict"))
    judged = measures.join(hosts, measures["host"].eqNullSafe(hosts["h"])).drop("h")
    bad = F.col("verdict") == "bad"
    judged = judged.withColumn("base_failed", base_failed()).withColumn(
        "soft_failed", F.when(bad, soft_failures(STRICT_LIMITS)).otherwise(soft_failures())
    )
    allowed = F.when(F.col("verdict") == "trusted", 1).otherwise(0)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("soft_failed") <= allowed))


def judge(
    docs: DataFrame, text: str = "text", host: str = "source", carried: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The measures of every row, ``base_failed, soft_failed, verdict, kept``, and the carried columns in ``row``."""
    measures = pin(measure(docs, text, host, carried), "measures")
    return _judged(measures, host_verdicts(measures))


def keep_good(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns unchanged.

    Texts are neither stored nor shuffled: they are measured once for the hosts and once more where they lie.
    """
    with temporary_tables(docs.sparkSession) as kept:
        verdicts = pin(host_verdicts(pin(measure(docs, text, host), "measures")), "verdicts")
        kept.append(verdicts)
    # A filter is not moved below a column that depends on the place of a row, so no measure is taken twice.
    placed = measure(docs, text, host, docs.columns).withColumn("place", F.monotonically_increasing_id())
    return _judged(placed, verdicts).where(F.col("kept") & (F.col("place") >= 0)).select("row.*")
