"""Quality rules (operator 5): measures of each text, and lines that recur across a host's documents. DataFrame functions only.

A line is hashed in normal form (lower case, digits as 0, white space as one space). Per host, the distinct texts that hold a
line are counted, so copies of one text count once. A line above both limits is taken out of every document of that host, and a
document left with too few words, or too small a share of them, is rejected. The hosts and lines meet in joins on (host, line),
which Spark may split where one is hot; nothing is collected.

A null text has no words, fails the base rules and is not kept; a null host is a host of its own; repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.text import fresh
from waybill.session import materialize

GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
LINE_DOCS = 50  # a line is common only in more distinct texts of the host than this
LINE_PERCENT = 10  # and in more than this share of them
LEFT_PERCENT = 30  # a document that keeps less of its words is depleted


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once a row, also inside another lambda."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def normal_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]", "0"), GAP, " "))


def without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def window_keys(words: Column) -> Column:
    """A hash of each window of WINDOW words."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    at = lambda a: F.transform(F.slice(a, 1, F.size(a) - (WINDOW - 1)), lambda x, i: F.xxhash64(x, *[F.get(a, i + k) for k in range(1, WINDOW)]))
    return F.when(F.size(words) >= WINDOW, bound(hashes, at)).otherwise(F.array().cast("array<bigint>"))


def covered(keys: Column) -> Column:
    """The number of words in windows whose key occurs twice or more."""
    placed = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))

    def again(s: Column) -> Column:
        same = lambda i, j: F.coalesce(F.get(s, i)["k"] == F.get(s, j)["k"], F.lit(False))
        return F.transform(F.filter(s, lambda x, j: same(j, j - 1) | same(j, j + 1)), lambda x: x["i"])

    steps = lambda p: F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW))))
    total = F.aggregate(bound(F.sort_array(bound(placed, again)), steps), F.lit(0), lambda a, x: a + x)
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0)).otherwise(total)


def measures(docs: DataFrame, *keep: str) -> DataFrame:
    """Per row: the columns kept, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and base_failed."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    split = docs.select(*keep, text.alias("__text"), words_of(text).alias("__words"))
    lines = F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    keyed = split.select(*keep, "__text", F.size("__words").cast("long").alias("n_words"), F.length(F.array_join("__words", "")).cast("long").alias("word_chars"), lines.alias("__lines"), window_keys(F.col("__words")).alias("__keys"))
    found = keyed.select(
        *keep,
        "n_words",
        "word_chars",
        (F.length("__text") - F.length(without(F.col("__text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        covered(F.col("__keys")).cast("long").alias("n_repeat_words"),
    )
    return found.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))


def row_key(host: str) -> Column:
    """Equal for rows of one doc_id, host and text."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce(F.col(host), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit("")))


def line_table(docs: DataFrame, host: str = "source") -> DataFrame:
    """Per distinct row: its key, host, text hash, and for each line with words the hash of its normal form and its words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return docs.select(
        row_key(host).alias("row"),
        F.coalesce(F.col(host), F.lit("")).alias("host"),
        F.xxhash64(text).alias("content"),
        F.transform(lines, lambda x: F.struct(F.xxhash64(normal_line(x)).alias("line"), F.size(words_of(x)).alias("n"))).alias("lines"),
    )


def common_lines(lines: DataFrame, docs_limit: int = LINE_DOCS, percent: int = LINE_PERCENT) -> DataFrame:
    """(host, line) of the lines in more than docs_limit, and more than percent, of the host's distinct texts."""
    texts = lines.select("host", "content", F.array_distinct(F.col("lines.line")).alias("lines")).groupBy("host", "content").agg(F.first("lines").alias("lines"))
    counts = texts.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") > docs_limit)
    hosts = lines.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("texts"))
    return counts.join(hosts, "host").where(100 * F.col("n") > percent * F.col("texts")).select("host", "line")


def judged(docs: DataFrame, host: str = "source") -> DataFrame:
    """Per row: doc_id, the measures, base_failed, n_common_words (in lines taken out) and kept."""
    lines = materialize(line_table(docs, host), "lines")
    common = common_lines(lines)
    each = lines.dropDuplicates(["row"]).select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.line", "x.n")
    taken = each.join(common, ["host", "line"]).groupBy("row").agg(F.sum("n").alias("n_common_words"))
    rows = measures(docs.select("doc_id", "text", host, row_key(host).alias("row")), "doc_id", "row")
    joined = rows.join(taken, "row", "left").drop("row").fillna(0, ["n_common_words"])
    left = F.col("n_words") - F.col("n_common_words")
    depleted = (F.col("n_common_words") > 0) & ((left < MIN_WORDS) | (100 * left < LEFT_PERCENT * F.col("n_words")))
    return joined.withColumn("kept", ~F.col("base_failed") & ~depleted)


def cleaned(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows with the common lines of their host taken out of `text`; other columns as they are, rejected rows too."""
    common = common_lines(line_table(docs, host))
    keyed = docs.select(row_key(host).alias("__row"), F.coalesce(F.col(host), F.lit("")).alias("host"), F.col("text").cast("string").alias("text"))
    each = keyed.dropDuplicates(["__row"]).select("__row", "host", F.posexplode(F.split("text", "\n")).alias("at", "words"))
    left = each.withColumn("line", F.xxhash64(normal_line(F.col("words")))).join(common, ["host", "line"], "left_anti")
    texts = left.groupBy("__row").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "words"))), lambda x: x["words"]), "\n").alias("__text"))
    row, new = fresh("row", docs.columns), fresh("new_text", docs.columns)
    whole = docs.withColumn(row, row_key(host)).join(texts.toDF(row, new), row, "left")
    return whole.withColumn("text", F.when(F.col("text").isNotNull(), F.coalesce(new, F.lit("")))).select(*docs.columns)
