"""Quality rules: repetition within a text, and lines that a host repeats across documents.

Rules within a text give the base verdict. Then every line is normalised and
hashed, and for each host (``source``) the distinct documents that hold a
line are counted. A line in at least ``line_docs`` of a host's documents, and
in more than ``line_share`` of them, is frequent. Near copies of one document
make all its lines frequent; they are no boilerplate, so a document counts as
its own only if frequent lines make up at most ``own_share`` of its words,
and a frequent line is boilerplate if documents of their own alone still pass
both limits. It is removed everywhere on its host; a document that keeps too
little of itself is rejected as depleted.

DataFrame operations only. A document sends each of its distinct lines once,
as a number; counting is by (host, line, document) first, so neither a hot
host nor a line that a third of all documents share gathers in one task. What
is gathered by document is never more than the document's own lines.

Cases: a null text has no words and fails; a null source is a host of its
own; repeated rows of one document count once per line and get one row each;
null ids count as one document; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.text import fresh, words_of
from strata.session import stage_table

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

LINE_SHARE = 0.001
LINE_DOCS = 10
#: Most of a document's words that may stand in frequent lines if it is to count as its own.
OWN_SHARE = 0.5
#: A depleted document keeps less than this share of its words, or fewer words than that.
LEFT_SHARE = 0.3
LEFT_WORDS = 25
#: Most bytes of decisions that are broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 32 << 20


def _high(x: Column, bits: Column) -> Column:
    return F.call_function("shiftright", x, bits)


def _twins(hashes: Column, bits: Column) -> Column:
    """Numbers (hash in the high bits, place in the low ones) in order of hash, and there next to an equal one."""
    return F.filter(
        hashes,
        lambda x, k: F.coalesce(_high(F.get(hashes, k - 1), bits) == _high(x, bits), F.lit(False))
        | F.coalesce(_high(F.get(hashes, k + 1), bits) == _high(x, bits), F.lit(False)),
    )


def with_repeats(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words in 3-word windows found twice or more in ``words``.

    A text whose windows all have different hashes has none. Else windows are
    sorted as (hash, place) numbers within the row and compared with their
    neighbours; what looks repeated is compared once more under another hash,
    so that the number is right unless two hashes collide at once.
    """
    words, n = F.col("words"), F.size("words")
    hashes = F.transform("words", lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    out = df.withColumn("_all", F.slice(hashes, F.lit(1), F.greatest(n - 2, F.lit(0))))
    bits = F.ceil(F.log2(n.cast("double") + 2)).cast("int")
    out = out.withColumn("_bits", F.when(F.size(F.array_distinct("_all")) < F.size("_all"), bits))
    packed = lambda h, i: F.call_function("shiftleft", h, F.col("_bits")).bitwiseOR(i.cast("long"))
    place = lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bits")) - 1)
    again = lambda p: F.xxhash64(
        F.lit(1), F.get(words, p.cast("int")), F.get(words, p.cast("int") + 1), F.get(words, p.cast("int") + 2)
    )
    some = F.col("_bits").isNotNull()
    out = out.withColumn("_sorted", F.when(some, F.sort_array(F.transform("_all", packed))))
    out = out.withColumn("_places", F.when(some, F.transform(_twins(F.col("_sorted"), F.col("_bits")), place)))
    out = out.withColumn(
        "_sorted", F.when(some, F.sort_array(F.transform("_places", lambda p: packed(again(p), p))))
    )
    out = out.withColumn(
        "_places", F.when(some, F.sort_array(F.transform(_twins(F.col("_sorted"), F.col("_bits")), place)))
    )
    covered = F.transform(
        "_places", lambda p, k: F.least(F.lit(3), F.coalesce(F.get(F.col("_places"), k + 1), p + 3) - p)
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return out.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop(
        "_all", "_bits", "_sorted", "_places"
    )


def normal_lines(text: Column) -> Column:
    """Lines of a text in lower case, trimmed, with single blanks between words."""
    plain = F.lower(text)
    for blank in "\t\x0b\x0c\r":
        plain = F.replace(plain, F.lit(blank), F.lit(" "))
    plain = F.when(F.contains(plain, F.lit("  ")), F.regexp_replace(plain, " +", " ")).otherwise(plain)
    return F.transform(F.split(plain, "\n"), lambda x: F.trim(x))


def text_rules(docs: DataFrame) -> DataFrame:
    """Base figures of every text, and its lines as (hash, words) numbers."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.col("source").alias("host"), text.alias("text"))
    rows = rows.withColumns({
        "words": words_of(F.col("text")),
        "with_words": F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^ \t-\r]")),
        "lines": F.array_remove(normal_lines(F.col("text")), ""),
    })
    rows = with_repeats(rows)
    n = F.size("words").cast("long")
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)
    hashed = F.transform(
        "lines",
        lambda x: F.struct(
            F.xxhash64(x).alias("line"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("words")
        ),
    )
    return rows.select(
        "doc_id", "host", F.md5(F.concat_ws("\n", F.col("doc_id").cast("string"), "text")).alias("row_key"),
        n.alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size("with_words") - F.size(F.array_distinct("with_words"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words", failed.alias("base_failed"), hashed.alias("lines"),
    )


def host_documents(lines: DataFrame) -> DataFrame:
    """(host, host_docs): distinct documents of every host, from rows (host, doc_id)."""
    return lines.select("host", "doc_id").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))


def frequent_lines(lines: DataFrame, hosts: DataFrame, line_share: float = LINE_SHARE, line_docs: int = LINE_DOCS) -> DataFrame:
    """(host, line) above the limits, from rows (host, doc_id, line)."""
    counts = (
        lines.select("host", "line", "doc_id").distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs"))
    )
    return (
        counts.filter(F.col("n_docs") >= line_docs)
        .join(hosts, counts["host"].eqNullSafe(hosts["host"]))
        .filter(F.col("n_docs") > line_share * F.col("host_docs"))
        .select(counts["host"], "line")
    )


def lines_among(lines: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows (host, line, ...) whose line is one of its host's chosen ones."""
    chosen = chosen.select(F.col("host").alias("_host"), F.col("line").alias("_line"))
    return lines.join(
        chosen, (F.col("line") == F.col("_line")) & F.col("host").eqNullSafe(F.col("_host")), "left_semi"
    )


def boilerplate_hits(
    rows: DataFrame, line_share: float = LINE_SHARE, line_docs: int = LINE_DOCS, own_share: float = OWN_SHARE
) -> DataFrame:
    """(row_no, host, line, words): every place of a boilerplate line, from rows with their ``lines``."""
    lines = rows.select("row_no", "host", "doc_id", "n_words", F.explode("lines").alias("l"))
    lines = lines.select("row_no", "host", "doc_id", "n_words", "l.line", "l.words")
    hosts, _ = stage_table(host_documents(lines), "quality_hosts")
    frequent, _ = stage_table(frequent_lines(lines, hosts, line_share, line_docs), "quality_frequent")
    found = lines_among(lines, frequent).groupBy("row_no").agg(
        F.first("host").alias("host"), F.first("doc_id").alias("doc_id"),
        (F.sum("words") <= own_share * F.first("n_words")).alias("own"),
        F.collect_list(F.struct("line", "words")).alias("hits"),
    )
    found, _ = stage_table(found, "quality_hits")
    places = found.select("row_no", "host", "doc_id", "own", F.explode("hits").alias("l"))
    places = places.select("row_no", "host", "doc_id", "own", "l.line", "l.words")
    chosen, _ = stage_table(
        frequent_lines(places.filter("own"), hosts, line_share, line_docs), "quality_lines"
    )
    return lines_among(places.select("row_no", "host", "line", "words"), chosen)


def judge(
    docs: DataFrame,
    line_share: float = LINE_SHARE,
    line_docs: int = LINE_DOCS,
    left_share: float = LEFT_SHARE,
    left_words: int = LEFT_WORDS,
    own_share: float = OWN_SHARE,
) -> DataFrame:
    """Figures, removed lines (``dropped``) and verdict of every document."""
    rules = text_rules(docs).withColumn("row_no", F.monotonically_increasing_id())
    rows, _ = stage_table(rules, "quality_rows")
    hits = boilerplate_hits(rows, line_share, line_docs, own_share)
    removed = hits.groupBy("row_no").agg(F.sum("words").alias("removed_words"), F.collect_set("line").alias("dropped"))
    judged = rows.drop("lines").join(removed, "row_no", "left")
    left = F.col("n_words") - F.coalesce("removed_words", F.lit(0))
    depleted = F.col("removed_words").isNotNull() & (
        (left < left_words) | (left < left_share * F.col("n_words"))
    )
    return judged.withColumn("kept", ~F.col("base_failed") & ~depleted)


def clean_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that are kept, without the lines above the limits."""
    columns = docs.columns
    judged = judge(docs, **options)
    changes = (
        judged.filter(~F.col("kept") | F.col("dropped").isNotNull())
        .select("row_key", "kept", "dropped")
        .dropDuplicates(["row_key"])
    )
    changes, _ = stage_table(changes, "quality_changes")
    key_name, kept, dropped = fresh(columns, "_key", "_kept", "_dropped")
    key = F.md5(F.concat_ws("\n", F.col("doc_id").cast("string"), F.coalesce("text", F.lit(""))))
    small = changes.count() * 256 <= BROADCAST_BYTES
    other = changes.withColumnsRenamed({"row_key": key_name, "kept": kept, "dropped": dropped})
    joined = docs.withColumn(key_name, key).join(F.broadcast(other) if small else other, key_name, "left")
    joined = joined.filter(F.coalesce(kept, F.lit(True)))
    pairs = F.arrays_zip(F.split("text", "\n").alias("raw"), normal_lines(F.col("text")).alias("normal"))
    stay = F.filter(pairs, lambda x: ~F.array_contains(F.col(dropped), F.xxhash64(x["normal"])))
    stays = F.array_join(F.transform(stay, lambda x: x["raw"]), "\n")
    changed = F.col(dropped).isNotNull()
    out = joined.withColumn("text", F.when(changed, stays).otherwise(F.col("text")))
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*columns)
