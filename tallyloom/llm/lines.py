"""Line dedup by winnowing over line hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import free_name, hash60, session, table, word_count
from tallyloom.session import bounded_broadcast, stage

# Lines hashed together, and such hashes of which a window keeps the least: every repeated run of
# at least GRAM + WINDOW - 1 lines holds a fingerprint, and fingerprints overlap or touch.
GRAM = 2
WINDOW = 2
# A line of so many words is a run by itself.
LONG_WORDS = 50

_BLANKS = " \t\n\x0b\f\r"


def line_hash(line: Column) -> Column:
    return hash60(line, "line")


def document_key(key: str, text: str) -> Column:
    """What tells documents apart: the key and a hash of the text. Documents are ordered by it,
    null keys last."""
    return F.struct(
        F.col(key).isNull().alias("no_key"),
        F.col(key).alias("key"),
        hash60(F.col(text), "text").alias("digest"),
    )


def numbered_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    r"""``doc, line, pos, h, long``: the lines with a word, by their number in the text (``line``,
    split at \n) and among the lines with a word (``pos``), and whether they have ``LONG_WORDS``."""
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    kept = F.filter(
        F.transform(lines, lambda x, i: F.struct(i.alias("line"), x.alias("x"))),
        lambda s: F.length(F.translate(s["x"], _BLANKS, "")) > 0,
    )
    line = F.col("s.x")
    # Words are counted only where a line has blanks enough.
    blanks = F.length(line) - F.length(F.translate(line, _BLANKS, ""))
    long = F.when(blanks >= LONG_WORDS - 1, word_count(line) >= LONG_WORDS).otherwise(False)
    # One row for each document: repeated rows stand for one.
    return (
        docs.select(document_key(key, text).alias("doc"), kept.alias("kept"))
        .select("doc", F.posexplode("kept").alias("pos", "s"))
        .select("doc", F.col("s.line").alias("line"), "pos", line_hash(line).alias("h"), long.alias("long"))
        .distinct()
    )


def line_grams(lines: DataFrame, gram: int) -> DataFrame:
    """``doc, pos, g``: the hash of every ``gram`` lines in a row, by the first of them."""
    in_doc = Window.partitionBy("doc").orderBy("pos")
    parts = [F.lead("h", i).over(in_doc) for i in range(gram)]
    grams = lines.select("doc", "pos", F.array(*parts).alias("hs")).filter(
        F.col("hs")[gram - 1].isNotNull()
    )
    g = hash60(F.concat_ws(",", F.transform("hs", lambda x: x.cast("string"))), "gram")
    return grams.select("doc", "pos", g.alias("g"))


def winnowed(lines: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``doc, pos, g``: the fingerprints of each document, the rightmost least gram hash of every
    window of ``window`` grams; a document with fewer grams has one window of them all."""
    in_doc = Window.partitionBy("doc").orderBy("pos")
    grams = line_grams(lines, gram)
    least = F.min(F.struct("g", (-F.col("pos")).alias("p")))
    ahead = in_doc.rowsBetween(0, window - 1)
    full = F.row_number().over(Window.partitionBy("doc").orderBy(F.col("pos").desc())) >= window
    minima = grams.select("doc", "pos", least.over(ahead).alias("m"), full.alias("full")).filter(
        F.col("full") | (F.col("pos") == 0)
    )
    return minima.select("doc", (-F.col("m.p")).alias("pos"), F.col("m.g").alias("g")).distinct()


def repeated_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    gram: int = GRAM,
    window: int = WINDOW,
) -> DataFrame:
    """``doc, line``: the lines to delete, those of runs that an earlier place already has.

    Places are ordered by document key, then position. Winnowing selects fingerprints so that both
    copies of ``gram + window - 1`` lines select the same one. Around each fingerprint that occurs
    again, the runs of that many lines that hold it are held against their own first places, found
    by a grouped minimum, so a passage that most documents share costs one row per occurrence; the
    runs that stand earlier extend each other both ways as they overlap, and all their lines go.
    So exactly the lines of runs of ``gram + window - 1`` lines that stand earlier are deleted, and
    rows stay in proportion to lines. Lines of ``LONG_WORDS`` words are held against their own first
    places as well.
    """
    lines = stage(numbered_lines(docs, key, text), "lines")
    prints = stage(winnowed(lines, gram, window), "line-fingerprints")
    place = F.struct("doc", "pos")
    again = prints.groupBy("g").count().filter("count > 1").select("g")
    again = stage(again, "line-repeats")
    short = gram + window - 1
    starts = prints.join(bounded_broadcast(again), "g", "left_semi").select(
        "doc", F.explode(F.sequence(F.greatest(F.col("pos") - (window - 1), F.lit(0)), "pos")).alias("pos")
    )
    starts = stage(starts.distinct(), "line-run-starts")
    holders = stage(starts.select("doc").distinct(), "line-run-documents")
    held = lines.join(bounded_broadcast(holders), "doc", "left_semi")
    # Written, so that the joins below read both sides as they are and can split a hot one.
    runs = stage(line_grams(held, short).join(starts, ["doc", "pos"]), "line-runs")
    origin = runs.groupBy("g").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    origin = stage(origin.filter("n > 1").drop("n"), "line-run-first-places")
    later = runs.join(bounded_broadcast(origin), "g").filter(place > F.col("first"))
    places = later.select("doc", F.explode(F.sequence("pos", F.col("pos") + (short - 1))).alias("pos"))
    covered = held.join(places.distinct(), ["doc", "pos"]).select("doc", "line")
    long = lines.filter("long")
    source = long.groupBy("h").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    source = stage(source.filter("n > 1").drop("n"), "long-line-first-places")
    copies = long.join(bounded_broadcast(source), "h").filter(place > F.col("first"))
    return covered.unionByName(copies.select("doc", "line")).distinct()


def delete_repeated_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    gram: int = GRAM,
    window: int = WINDOW,
) -> DataFrame:
    r"""Input rows with the text freed of repeated runs of lines, and with ``n_deleted``.

    A run counts from ``gram + window - 1`` lines with a word on, or from one line of ``LONG_WORDS``
    words; lines without a word are neither compared nor deleted. The first place keeps the run: the document with the least key (null
    last), and in it the first position; so a document can repeat itself. Nothing else is touched:
    the other lines stay as they are, joined by \n. A text may become empty; null stays null. Rows
    equal in key and text stand for one document and are treated alike. A column ``n_deleted`` of
    the input is replaced.
    """
    base = docs.drop("n_deleted")
    gone = (
        repeated_lines(base, key, text, gram, window)
        .groupBy("doc")
        .agg(F.collect_set("line").alias("gone"))  # bounded by the lines of one text
    )
    gone = stage(gone, "deleted-lines")
    names = {n: free_name(base.columns, n) for n in ("_doc", "_gone")}
    found = gone.select(F.col("doc").alias(names["_doc"]), F.col("gone").alias(names["_gone"]))
    own = document_key(key, text)
    joined = base.join(bounded_broadcast(found), own.eqNullSafe(F.col(names["_doc"])), "left")
    lines = F.split(F.col(text), "\n", -1)
    left = F.transform(
        F.filter(
            F.transform(lines, lambda x, i: F.struct(i.alias("i"), x.alias("x"))),
            lambda s: ~F.array_contains(F.col(names["_gone"]), s["i"]),
        ),
        lambda s: s["x"],
    )
    cleaned = F.when(F.col(names["_gone"]).isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    return joined.select(
        *[cleaned.alias(c) if c == text else F.col(c) for c in base.columns],
        F.coalesce(F.size(names["_gone"]), F.lit(0)).cast("long").alias("n_deleted"),
    )


def op2_lines(spark, sf_dir):
    """All documents without their repeated runs of lines."""
    docs = table(session(spark), sf_dir, "documents")
    return delete_repeated_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_deleted", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5")
    )


# The same in SQL. Documents are ordered by doc_id alone there, which is unique in the tables.
OP2_SQL = rf"""
WITH split AS (
  SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
numbered AS (
  SELECT doc_id, unnest(ls) AS x, unnest(range(len(ls))) AS line FROM split),
lines AS (
  SELECT doc_id, line, x, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS pos
  FROM numbered WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
threes AS (
  SELECT doc_id, pos, x || chr(10) || lead(x, 1) OVER w || chr(10) || lead(x, 2) OVER w AS run
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
later AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS k
    FROM threes WHERE run IS NOT NULL) WHERE k > 1),
copies AS (
  SELECT doc_id, line FROM (
    SELECT doc_id, line, row_number() OVER (PARTITION BY x ORDER BY doc_id, pos) AS k
    FROM lines WHERE len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) >= {LONG_WORDS}) WHERE k > 1),
gone AS (
  SELECT doc_id, list(line) AS lines FROM (
    SELECT l.doc_id, l.line FROM lines l JOIN later r ON l.doc_id = r.doc_id AND l.pos BETWEEN r.pos AND r.pos + 2
    UNION SELECT doc_id, line FROM copies) GROUP BY doc_id)
SELECT s.doc_id, CAST(coalesce(len(g.lines), 0) AS BIGINT) AS n_deleted,
       md5(CASE WHEN g.lines IS NULL THEN coalesce(s.text, '') ELSE array_to_string(list_transform(
         list_filter(list_zip(s.ls, range(len(s.ls))), lambda z: NOT list_contains(g.lines, z[2])), lambda z: z[1]),
         chr(10)) END) AS text_md5
FROM split s LEFT JOIN gone g USING (doc_id)
"""
