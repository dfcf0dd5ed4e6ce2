"""Line dedup in DataFrame functions only.

Every text is split at line feeds, each line becomes the digest of its key (ends stripped, A-Z
lower-cased), and a key's documents are counted from one row for each distinct key of a
document, summed inside the tasks first.  Keys over the threshold are few and stored; joined
back to the exploded lines they give the positions that each text loses.  The texts are put
together again from the runs of lines between those positions.

Frequent keys never meet in one task: those that hold most lines are broadcast under a counted
bound, and only the rest of the exploded digests, without any text, is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.llm.common import Written, ascii_lower, set_aside, small_or_shuffled
from quillstream.operators.sizes import join_by_word

MIN_DOCS = 10
MIN_CHARS = 1
# Fixed value: what is stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"


def lines_of(text: str | Column) -> Column:
    """The lines of a text; null and empty texts are one empty line."""
    return F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _digests(text: str, min_chars: int) -> Column:
    """One digest for each line, null where the key is too short to be counted."""
    def one(line: Column) -> Column:
        return F.when(F.length(F.btrim(line, F.lit(BLANKS))) >= min_chars, F.md5(key_of(line).cast("binary")))

    return F.transform(lines_of(text), one)


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                   column: str = "text") -> DataFrame:
    """(line, n_docs): digests of the keys that stand in ``min_docs`` documents or more.

    A document is a row; a key counts once in it, however often it stands there.
    """
    each = docs.select(F.explode(F.array_distinct(_digests(column, min_chars))).alias("line"))
    return each.filter("line IS NOT NULL").groupBy("line").agg(F.count(F.lit(1)).alias("n_docs")) \
        .filter(F.col("n_docs") >= min_docs)


def _runs(lines: Column, dropped: Column) -> Column:
    """The lines outside the ascending positions ``dropped``, run by run: linear in the lines."""
    begins = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda p: p + 1))
    ends = F.concat(dropped, F.array(F.size(lines)))
    return F.flatten(F.transform(F.arrays_zip(begins.alias("begin"), ends.alias("end")), lambda x: F.slice(
        lines, x["begin"] + 1, x["end"] - x["begin"])))


def drop_frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                        column: str = "text") -> DataFrame:
    """``docs`` without the lines whose key stands in ``min_docs`` documents or more.

    All columns stay; ``n_lines`` (before dropping) and ``n_dropped`` follow and replace
    columns of these names.  Null texts become empty ones of one line.  A key shorter than
    ``min_chars`` code points, such as that of an empty line, is never dropped.  A text that
    loses all lines is empty.  Repeated rows are documents of their own and lose the same
    lines; ids are not looked at.  An empty table gives no rows.
    """
    apart, back = set_aside(docs.drop("n_lines", "n_dropped"), column)
    if column != "text":
        apart = apart.withColumnRenamed(column, "text")
        back = [F.col("text").alias(column) if name == column else b for name, b in
                zip(docs.drop("n_lines", "n_dropped").columns, back)]
    frequent = Written(frequent_lines(apart, min_docs, min_chars), "frequent-lines").df
    # Rows equal in text lose the same lines, so positions are kept once for each text.
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    # The digest is taken below the explode: above it, it would be taken again for every line.
    placed = apart.select(digest.alias("_of"), _digests("text", min_chars).alias("_keys")) \
        .select("_of", F.posexplode("_keys").alias("_at", "line"))
    hit = join_by_word(placed.filter("line IS NOT NULL"), frequent, "line", "n_docs")
    dropped = Written(hit.groupBy("_of").agg(F.sort_array(F.collect_set("_at")).alias("_dropped")), "positions").df
    texts = apart.withColumns({"_lines": lines_of("text"), "_own": digest})
    joined = texts.join(small_or_shuffled(dropped), F.col("_own") == F.col("_of"), "left")
    none = F.col("_dropped").isNull()
    kept = F.when(none, F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(_runs(F.col("_lines"), F.col("_dropped")), "\n"))
    return joined.withColumns({
        "text": kept, "_n": F.size("_lines").cast("bigint"),
        "_m": F.coalesce(F.size("_dropped"), F.lit(0)).cast("bigint"),
    }).select(*back, F.col("_n").alias("n_lines"), F.col("_m").alias("n_dropped"))


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row of ``docs``."""
    return drop_frequent_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
