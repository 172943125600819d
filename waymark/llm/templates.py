"""Line dedup by a log-template tree, in DataFrame operations.

Lines are split at white space; the first levels of the tree are a line's number of tokens and its ``LEADS`` leading tokens, where
tokens with a digit count as one wildcard. Lines at one leaf are generalised: a token stays in the template if at its place at least
``MIN_DOCS`` documents have it, else it becomes the wildcard; a line of which less than ``SIMILAR`` of the tokens stay is its own
template, and so is one of fewer than ``SHORT`` tokens unless all stay. A template that at least ``MIN_DOCS`` documents hold is recurring,
and all its lines are dropped from all of them, the first occurrence too: of a document that stands twice under different ids no line
is left in either copy, so drop plain copies before if one is to stay. Blank lines are never dropped.

First only hashes of the leaves are counted; the lines at leaves that fewer documents reach are never compared. Of the others equal
lines are one content, compared once, with the least and the greatest id of the documents that hold it: what two documents hold has two
different ones. Contents are read from one text that holds them, so texts are shuffled once,
by id. Tokens meet at their places of the leaf, and only those that stay go back to their line. Contents and templates are told
apart by two 64-bit hashes, that of the leaf and their own.

Nulls: a null text has no lines and stays null; null ids are one document. Rows with an equal id are one document in the counts, and their
lines are told apart by a hash of the text; of rows that repeat id and text one is read. An empty table gives an empty result; other columns are kept, but for those named like
the results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.common import materialise

LEADS = 2
MIN_DOCS = 2  # the counts below rely on two: a least id that is not the greatest
SIMILAR = 0.6
SHORT = 4
WILDCARD = "<*>"
RESULTS = ("n_lines", "n_dropped", "clean_text")


def lines(text: str = "text") -> Column:
    return F.split(F.col(text), "\n")


# Lines with one of these take the longer way: a digit may make a token a wildcard, the others separate tokens like a space.
SPECIAL = r"[0-9\x09-\x0D]"


def tokens(line: Column, special: Column) -> Column:
    """The tokens of a line. Most lines have spaces only, at which Spark splits without a pattern."""
    return F.array_remove(F.when(special, F.split(line, r"[\x20\x09-\x0D]+")).otherwise(F.split(line, " ")), "")


def masked(token: Column, special: Column) -> Column:
    return F.when(special & token.rlike("[0-9]"), F.lit(WILDCARD)).otherwise(token)


def line_rows(docs: DataFrame) -> DataFrame:
    """doc_id, body (hash of the text), no, leaf, content (hash of the tokens) of the lines that aren't blank."""
    # The hash comes first: next to the explode it would be computed for each line.
    rows = docs.withColumn("body", F.xxhash64("text")).select("doc_id", "body", F.posexplode(lines()).alias("no", "line"))
    rows = rows.filter(F.btrim("line", F.lit(" \t\x0b\x0c\r")) != "").withColumn("special", F.col("line").rlike(SPECIAL))
    rows = rows.withColumn("tokens", tokens(F.col("line"), F.col("special")))
    leaf = F.xxhash64(F.size("tokens"), *(masked(F.try_element_at("tokens", F.lit(k + 1)), F.col("special")) for k in range(LEADS)))
    return rows.select("doc_id", "body", "no", leaf.alias("leaf"), F.xxhash64("tokens").alias("content"))


# Stands for a null id.
NO_ID = -(1 << 63)


def at_recurring_leaves(rows: DataFrame) -> DataFrame:
    """The rows of ``rows`` at leaves that MIN_DOCS documents reach."""
    per_doc = rows.groupBy("leaf", "doc_id").agg(F.lit(1).alias("one"))
    held = per_doc.groupBy("leaf").agg(F.count("*").alias("docs")).filter(F.col("docs") >= MIN_DOCS).select("leaf")
    return rows.join(held, "leaf", "left_semi")


def contents(rows: DataFrame) -> DataFrame:
    """leaf, content, lo, hi (least and greatest document that hold it), and one place of it: _id, _body, no."""
    per_doc = rows.groupBy("leaf", "content", "doc_id").agg(F.min(F.struct("body", "no")).alias("b"))
    number = F.coalesce("doc_id", F.lit(NO_ID))
    made = per_doc.groupBy("leaf", "content").agg(F.min(number).alias("lo"), F.max(number).alias("hi"), F.min(F.struct("doc_id", "b")).alias("rep"))
    return made.select("leaf", "content", "lo", "hi", F.col("rep.doc_id").alias("_id"), F.col("rep.b.body").alias("_body"), F.col("rep.b.no").alias("no"))


def marked(rows: DataFrame, *key: str) -> DataFrame:
    """``rows`` with held: MIN_DOCS documents have the row's ``key``. By windows over the key, so that rows meet once."""
    own = Window.partitionBy(*key)
    return rows.withColumn("held", F.min("lo").over(own) < F.max("hi").over(own))


def own_row() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("body") == F.col("_body"))


def dropped_contents(keyed: DataFrame, compared: DataFrame) -> DataFrame:
    """leaf, content of the lines of recurring templates. ``keyed``: doc_id, text, body; ``compared``: see contents."""
    listed = compared.groupBy("_id", "_body").agg(F.collect_list(F.struct("no", "leaf", "content", "lo", "hi")).alias("held"))
    # Of rows that repeat id and text one is read. The keys are those of the join, so that the rows stay where they are, and the texts'
    # shuffle is the one that the last join needs too.
    texts = keyed.join(listed, own_row()).groupBy(F.coalesce("doc_id", F.lit(0).cast("long")).alias("_doc"), F.col("doc_id").isNull().alias("_null"), "body")
    texts = texts.agg(F.first("text").alias("text"), F.first("held").alias("held"))
    # The split comes before the explode, else every line would split its text.
    rows = texts.withColumn("lines", lines()).select("lines", F.explode("held").alias("h"))
    rows = rows.select("h.leaf", "h.content", "h.lo", "h.hi", F.element_at("lines", F.col("h.no") + 1).alias("line"))
    rows = rows.withColumn("special", F.col("line").rlike(SPECIAL)).withColumn("tokens", tokens(F.col("line"), F.col("special"))).drop("line")
    row = F.xxhash64("leaf", "content").alias("row")
    cells = rows.select(row, "leaf", "lo", "hi", "special", F.posexplode("tokens").alias("place", "token"))
    cells = cells.select("row", "lo", "hi", F.xxhash64("leaf", "place", masked(F.col("token"), F.col("special"))).alias("cell"))
    stay = marked(cells, "cell").filter("held").groupBy("row").agg(F.bit_xor("cell").alias("general"), F.count("*").alias("same"))
    whole = F.xxhash64(F.when(F.col("special"), F.transform("tokens", lambda t: masked(t, F.lit(True)))).otherwise(F.col("tokens")))
    lines_ = rows.select("leaf", "content", "lo", "hi", F.size("tokens").alias("size"), whole.alias("whole"), row).join(stay, "row", "left")
    # The leaf holds the number of tokens, so the tokens that stay tell the template.
    enough = F.col("same") >= F.when(F.col("size") < SHORT, F.col("size")).otherwise(F.col("size") * SIMILAR)
    template = F.when(enough, F.xxhash64("general")).otherwise(F.xxhash64(F.lit("own"), "whole"))
    return marked(lines_.select("leaf", "content", "lo", "hi", template.alias("template")), "leaf", "template").filter("held").select("leaf", "content")


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) with n_lines, n_dropped and clean_text (what is left, joined by line feeds)."""
    rows = docs.select(*(f"`{c}`" for c in docs.columns if c not in RESULTS))
    keyed = rows.filter("text is not null").withColumn("body", F.xxhash64("text"))
    found = materialise(at_recurring_leaves(materialise(line_rows(rows.filter("text is not null")))))
    compared = materialise(contents(found))
    dropped = found.join(dropped_contents(keyed.select("doc_id", "text", "body"), compared), ["leaf", "content"], "left_semi")
    dropped = dropped.groupBy(F.col("doc_id").alias("_id"), F.col("body").alias("_body")).agg(F.array_sort(F.collect_set("no")).alias("_dropped"))
    joined = keyed.join(dropped, own_row(), "left").withColumn("_lines", lines())
    # What is left lies between one dropped line and the next: runs of lines, read once however many there are.
    ends = F.concat(F.col("_dropped"), F.array(F.size("_lines")))
    runs = F.zip_with(F.concat(F.array(F.lit(-1)), F.col("_dropped")), ends, lambda a, b: F.slice(F.col("_lines"), a + 2, b - a - 1))
    clean = F.when(F.col("_dropped").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(runs), "\n"))
    counts = {"n_lines": F.size("_lines").cast("long"), "n_dropped": F.when(F.col("_dropped").isNull(), 0).otherwise(F.size("_dropped")).cast("long"), "clean_text": clean}
    done = joined.withColumns(counts).drop("body", "_id", "_body", "_dropped", "_lines")
    empty = {"n_lines": F.lit(0).cast("long"), "n_dropped": F.lit(0).cast("long"), "clean_text": F.lit(None).cast("string")}
    return done.unionByName(rows.filter("text is null").withColumns(empty))
