"""Removal of repeated passages by content-defined line chunks (operator 10),
DataFrame functions only.

Every text is cut into chunks of lines. A line ends a chunk if the rolling hash
of the last ``WINDOW`` line hashes, inside the text, is 0 modulo ``DIVISOR``:
boundaries depend on nearby lines alone, so a passage that moved by some lines
is cut at the same places. Chunks of at least ``MIN_LINES`` lines that occur in
more than one place are kept at their first place (smallest id, then smallest
position) and removed everywhere else.

Plan: a narrow pass counts chunk hashes; chunks whose hash repeats are gathered
with their bytes (one shuffle of the texts, by hash), grouped by hash and bytes
(the byte comparison: equal hashes of different chunks stay apart), and every
place but the first becomes a removal, collected per document. One join of the
texts with the removals rebuilds them. Counts and first places are partial
aggregates, and a passage in a third of all documents is spread by AQE's skew
join where its places meet its first one.

Defined results: a null text stays null and has 0 lines; an empty text is one
empty line; a null id sorts before others; rows that repeat in id and text are
one document, they keep and lose the same chunks; a document all of whose
chunks go has the empty text. Other columns are carried along unread.

``dedup_passages`` is the same job without anchors: chunks miss a passage whose
cuts fall into its neighbours, most of all a short one. Its units are every two
neighbouring lines and every line of over ``MIN_WORDS`` words. A line goes if it
lies in a unit that stands at an earlier place too, so every run of two lines or
more, or of one such line, goes whole wherever it was seen before, whatever
stands around it. Every different line of the corpus stays at its first place at
least. A longer run needs no search of its own: it is repeated only if all of
its units are. Units are equal if their SHA-256 is; only that and their place
are shuffled (a partial aggregate for the first places, a join by merge for the
others), and one join of the texts with the lines to remove rebuilds them. Of
three or more equal neighbouring lines one stays, and blank lines are lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import stored, word_count

WINDOW = 2
DIVISOR = 2
MIN_LINES = 2
MIN_WORDS = 50
BASE = 31


def chunks(text: Column, window: int = WINDOW, divisor: int = DIVISOR) -> Column:
    """Array of (n_lines, chunk) of a text; null for null."""
    lines = F.split(text, "\n", -1)
    hashed = F.transform(lines, lambda x: F.conv(F.substring(F.md5(x.cast("binary")), 1, 8), 16, 10)
                         .cast("long"))

    def cut(s: Column) -> Column:
        def rolling(i: Column) -> Column:
            return sum((F.get(s["h"], i - k) * F.lit(BASE ** k) for k in range(1, window)),
                       F.get(s["h"], i))
        n = F.size(s["l"])
        ends = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == n - 1) | (
            (i >= window - 1) & (F.pmod(rolling(i), F.lit(divisor)) == 0)))
        return F.transform(
            F.arrays_zip(F.concat(F.array(F.lit(-1)), F.slice(ends, F.lit(1), F.size(ends) - 1))
                         .alias("a"), ends.alias("b")),
            lambda e: F.struct((e["b"] - e["a"]).alias("n_lines"),
                               F.array_join(F.slice(s["l"], e["a"] + 2, e["b"] - e["a"]), "\n")
                               .alias("chunk")))

    # the struct is named once so that lines and hashes are made once
    made = F.transform(F.array(F.struct(lines.alias("l"), hashed.alias("h"))), cut)
    return F.when(text.isNotNull(), F.get(made, F.lit(0)))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents by ``id_key, text_key`` with their id and text."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id_key"),
        F.xxhash64("text").alias("text_key"), "doc_id", "text")


def _places(keyed: DataFrame, min_lines: int) -> DataFrame:
    return (keyed.filter(F.col("text").isNotNull())
            .select("doc_id", "id_key", "text_key", F.posexplode(chunks(F.col("text"))).alias("pos", "c"))
            .filter(F.col("c.n_lines") >= min_lines)
            .select(F.xxhash64("c.chunk").alias("hash"), "c.chunk", "doc_id", "id_key", "text_key", "pos"))


def removals(keyed: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """(id_key, text_key, gone): positions of the chunks to remove."""
    places = _places(keyed, min_lines)
    repeated = stored(places.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
                      .filter("n > 1").select("hash"), "repeated")
    # what repeats and what goes grows with the corpus: neither is broadcast
    found = stored(places.join(repeated.hint("merge"), "hash", "left_semi"), "found")
    place = F.struct("doc_id", "id_key", "text_key", "pos")
    first = stored(found.groupBy("hash", "chunk").agg(F.min(place).alias("first")), "first")
    return (found.join(first.hint("merge"), ["hash", "chunk"])
            .filter(~F.col("first").eqNullSafe(place))
            .groupBy("id_key", "text_key").agg(F.collect_set("pos").alias("gone")))


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``docs`` with repeated chunks cut out of the text, and the columns
    ``n_lines``, ``lines_removed`` and ``chunks_removed`` at the end."""
    gone = stored(removals(_keyed(docs, id_col, text_col), min_lines), "gone")
    cols = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    text = f"doc.c{docs.columns.index(text_col)}"
    base = docs.select(F.struct(*cols).alias("doc"),
                       F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id_key"),
                       F.xxhash64(text_col).alias("text_key"))
    parts = (base.join(gone.hint("merge"), ["id_key", "text_key"], "left")
             .withColumn("parts", F.transform(
                 chunks(F.col(text)), lambda c, i: F.struct(
                     c["n_lines"].alias("n_lines"), c["chunk"].alias("chunk"),
                     F.coalesce(F.array_contains("gone", i), F.lit(False)).alias("drop")))))
    kept = F.filter("parts", lambda p: ~p["drop"])
    lost = F.filter("parts", lambda p: p["drop"])
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, p: a + p["n_lines"])
    clean = F.when(F.size(F.coalesce("gone", F.array().cast("array<int>"))) == 0, F.col(text)) \
        .otherwise(F.array_join(F.transform(kept, lambda p: p["chunk"]), "\n"))
    return parts.select(
        *[(clean if c == text_col else F.col(f"doc.c{i}")).alias(c)
          for i, c in enumerate(docs.columns)],
        F.coalesce(total(F.col("parts")), F.lit(0)).alias("n_lines"),
        F.coalesce(total(lost), F.lit(0)).alias("lines_removed"),
        F.greatest(F.size(lost), F.lit(0)).alias("chunks_removed"))


def units(text: Column, min_words: int = MIN_WORDS) -> Column:
    """Array of (line, pair, single) of a text: the digests of a line with its
    follower, and of the line alone if it is of over ``min_words`` words."""
    digest = lambda x: F.unhex(F.sha2(x.cast("binary"), 256))
    # so many words need as many separators: shorter lines are not counted
    long = lambda x: (F.length(x) > 2 * min_words) & (word_count(x) > min_words)

    def cut(s: Column) -> Column:
        return F.transform(s["l"], lambda x, i: F.struct(
            i.alias("line"),
            F.when(i < F.size(s["l"]) - 1, digest(F.concat(x, F.lit("\n"), F.get(s["l"], i + 1)))).alias("pair"),
            F.when(long(x), digest(x)).alias("single")))

    made = F.transform(F.array(F.struct(F.split(text, "\n", -1).alias("l"))), cut)
    return F.when(text.isNotNull(), F.get(made, F.lit(0)))


def repeated_lines(keyed: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(id_key, text_key, gone): numbers of the lines to remove."""
    by_line = (keyed.filter(F.col("text").isNotNull())
               .select("doc_id", "text_key", F.explode(units(F.col("text"), min_words)).alias("u")))
    both = F.array(F.struct(F.lit(2).alias("size"), F.col("u.pair").alias("unit")),
                   F.struct(F.lit(1).alias("size"), F.col("u.single").alias("unit")))
    places = (by_line.select(F.struct("doc_id", "text_key", "u.line").alias("place"),
                             F.explode(both).alias("b"))
              .filter(F.col("b.unit").isNotNull()).select("b.unit", "b.size", "place"))
    first = stored(places.groupBy("unit").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
                   .filter("n > 1").drop("n"), "first")
    again = (places.join(first.hint("merge"), "unit").filter(~F.col("first").eqNullSafe(F.col("place")))
             .select(F.coalesce(F.col("place.doc_id").cast("string"), F.lit("")).alias("id_key"),
                     "place.text_key", "place.line", "size"))
    of = lambda n: F.collect_set(F.when(F.col("size") == n, F.col("line")))
    return (again.groupBy("id_key", "text_key").agg(of(1).alias("one"), of(2).alias("two"))
            .select("id_key", "text_key", F.array_union(
                "one", F.array_union("two", F.transform("two", lambda i: i + 1))).alias("gone")))


def dedup_passages(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``docs`` with every line cut out of the text that is part of a passage
    seen before, and the columns ``n_lines``, ``lines_removed`` and
    ``runs_removed`` at the end."""
    gone = stored(repeated_lines(_keyed(docs, id_col, text_col), min_words), "gone")
    cols = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    text = F.col(f"doc.c{docs.columns.index(text_col)}")
    base = docs.select(F.struct(*cols).alias("doc"),
                       F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id_key"),
                       F.xxhash64(text_col).alias("text_key"))
    joined = base.join(gone.hint("merge"), ["id_key", "text_key"], "left")
    lines = F.split(text, "\n", -1)
    rest = lambda s: F.array_except(F.sequence(F.lit(0), F.size(s["l"]) - 1), F.col("gone"))
    clean = F.get(F.transform(F.array(F.struct(lines.alias("l"))), lambda s: F.array_join(
        F.transform(rest(s), lambda i: F.get(s["l"], i)), "\n")), F.lit(0))
    starts = F.array_except("gone", F.transform("gone", lambda i: i + 1))
    return joined.select(
        *[(F.when(F.col("gone").isNull(), text).otherwise(clean) if c == text_col
           else F.col(f"doc.c{i}")).alias(c) for i, c in enumerate(docs.columns)],
        F.when(text.isNull(), 0).otherwise(F.size(lines)).alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).alias("lines_removed"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size(starts)).alias("runs_removed"))
