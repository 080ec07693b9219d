"""Operator 8: repeated runs of lines, by a suffix array over line ids; DataFrame functions only.

Each line gets an id (its hash). Lines that occur once part a document into stretches of lines that
occur elsewhere too; stretches too short to hold a run that counts are left out. The suffixes of
all stretches are ranked by prefix doubling: a round has each place's rank by its first h lines,
takes the pair (own rank, rank h places on), sorts the distinct pairs over ranges, and ranks places
by them for 2 h lines. A run that counts has at least ``least`` words, and each line counts as one
word or more, so ``least`` lines are as deep as suffixes must be told apart, whatever the texts.

Suffixes that begin with the same n lines are neighbours in the suffix array: an interval within
which every longest common prefix of neighbours is n lines or more. Such an interval is named by n,
the rank of its first 2**k lines and the rank of its last 2**k lines (2**k <= n < 2**(k + 1)). The
two blocks overlap and cover the n lines; ranks of a level are equal just where its 2**k lines are.
So two places have one name just if their first n lines are equal, that is, if no prefix between
them in the suffix array is shorter than n: names and intervals are the same thing (the test holds
them against a plain suffix array). The interval's first place in the corpus is a minimum over its
name, taken before the shuffle, where a walk along the prefix array would have an interval, which
can hold a third of all lines, in one task.

A repeated run of enough words is covered by runs that have enough words only just: the shortest
that begins at a line, and the shortest that ends at a line. So the lines to delete are those in
such a run that occurred before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

#: Words that a repeated run must have.
LEAST = 50

#: White space other than a plain one, of ASCII and Unicode; and what a text has if its words are not parted by single spaces.
_OTHER = r"\t\x0B\f\r\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_SPACE = f" {_OTHER}"
_ODD = rf"[{_OTHER}]|  |^ |\n | \n| $"

#: What tells documents apart (an id, and 128 bits of the text), and the columns of a place, in the order of the corpus.
_DOC = ("doc_id", "h1", "h2")
_PLACE = (*_DOC, "line")


def _weight(line: Column, odd: Column) -> Column:
    """Words of a line: pieces between white space, at least 1. Lines of texts that are not ``odd`` have single spaces, which are counted faster."""
    spaces = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))
    return F.when(odd, F.greatest(F.regexp_count(line, F.lit(f"[^{_SPACE}]+")), F.lit(1))).otherwise(spaces + 1)


def _let(value: Column, use) -> Column:
    return F.element_at(F.transform(F.array(value), use), 1)


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, h1, h2, line (from 0), a and b (the line's id, 128 bits), words."""
    marked = docs.withColumn("odd", F.col("text").rlike(_ODD))  # of the text, before its lines are rows
    each = marked.select(*_DOC, "odd", F.posexplode(F.split("text", "\n", -1)).alias("line", "own"))
    return each.select(*_DOC, "line", F.xxhash64("own").alias("a"), F.xxhash64("own", F.lit(7)).alias("b"), _weight(F.col("own"), F.col("odd")).alias("words"))


def _stretches(docs: DataFrame, least: int) -> DataFrame:
    """Places in stretches of repeated lines: doc_id, h1, h2, line, stretch, a, b, forth, back.

    forth: lines of the shortest run of enough words that begins here; back: that ends here (null: none).
    """
    lines = written(_lines(docs), "lines")
    repeated = written(lines.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").select("a", "b"), "repeated")
    own = lines.join(repeated, ["a", "b"]).dropDuplicates(_PLACE)
    by_doc = Window.partitionBy(*_DOC).orderBy("line")
    marked = own.withColumn("stretch", F.col("line") - F.row_number().over(by_doc))
    parts = marked.groupBy(*_DOC, "stretch").agg(F.sum("words").alias("total"), F.array_sort(F.collect_list(F.struct("line", "words", "a", "b"))).alias("places")).where(F.col("total") >= least)

    def steps(weights: Column) -> Column:
        """How many items, from the first, add up to enough; null if all do not."""
        begin = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("n"))
        more = lambda s, w: F.when(s["sum"] >= least, s).otherwise(F.struct((s["sum"] + w).alias("sum"), (s["n"] + 1).alias("n")))
        return F.aggregate(weights, begin, more, lambda s: F.when(s["sum"] >= least, s["n"]))

    def both(w: Column) -> Column:
        turned = lambda i: F.reverse(F.slice(w, F.greatest(i + 2 - least, F.lit(1)), F.least(i + 1, F.lit(least))))
        return F.transform(w, lambda _, i: F.struct(steps(F.slice(w, i + 1, least)).alias("forth"), steps(turned(i)).alias("back")))

    runs = _let(F.transform("places", lambda x: x["words"].cast("long")), both)
    rows = parts.select(*_DOC, "stretch", F.explode(F.arrays_zip(F.col("places"), runs.alias("runs"))).alias("p"))
    return rows.select(*_DOC, "stretch", F.col("p.places.line").alias("line"), F.col("p.places.a").alias("a"), F.col("p.places.b").alias("b"), F.col("p.runs.forth").alias("forth"), F.col("p.runs.back").alias("back"))


def suffix_ranks(places: DataFrame, rounds: int) -> DataFrame:
    """places (doc_id, h1, h2, stretch, line, a, b, ...) with r0 .. r<rounds>: ranks by the first 1, 2, 4 ... lines.

    Ranks are ordered as suffixes of line ids are, and equal where those lines are equal; a suffix
    that ends sooner comes first. Each round sorts distinct pairs, not places, so a pair that is in
    a third of all places is one row; and the join that hands the ranks back splits such pairs.
    """
    names = {"a": "a", "b": "b"}
    ranked = places
    for k in range(rounds + 1):
        if k:
            on = Window.partitionBy(*_DOC, "stretch").orderBy("line")
            ranked = ranked.withColumns({"a": F.col(f"r{k - 1}"), "b": F.coalesce(F.lead(f"r{k - 1}", 1 << (k - 1)).over(on), F.lit(-1))})
        ranked = written(ranked, f"suffixes{k}")
        pairs = ranked.select(*names).groupBy(*names).count().drop("count")
        order = written(pairs.orderBy(*names).withColumn(f"r{k}", F.monotonically_increasing_id()), f"order{k}")
        ranked = ranked.join(order, list(names)).drop(*names)
    return ranked


def _named(n: Column, levels: int, ahead) -> list[Column]:
    """An interval's name: n, and two ranks of 2**k lines; ahead(k, i) is level k's rank i places on."""
    own, other = F.lit(None).cast("long"), F.lit(None).cast("long")
    for k in range(levels):
        here = (n >= (1 << k)) & (n < (1 << (k + 1)))
        own = F.when(here, ahead(k, F.lit(0))).otherwise(own)
        other = F.when(here, ahead(k, n - (1 << k))).otherwise(other)
    return [n.alias("n"), own.alias("own"), other.alias("other")]


def named_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, h1, h2, line, n, own, other: the runs of n lines from that one with enough words only just, and their intervals' names.

    docs: doc_id, h1, h2 (which tell documents apart), text. Runs with a line that occurs once are left out.
    """
    levels = max(1, least.bit_length())
    ranked = suffix_ranks(written(_stretches(docs, least), "stretches"), levels - 1)
    ranks = [f"r{k}" for k in range(levels)]
    rows = ranked.groupBy(*_DOC, "stretch").agg(F.array_sort(F.collect_list(F.struct("line", "forth", "back", *ranks))).alias("p"))

    def runs(p: Column) -> Column:
        def two(x: Column, i: Column) -> Column:
            def at(begin: Column):
                return lambda k, j: F.get(p, (begin + j).cast("int"))[f"r{k}"]

            begin = i + 1 - x["back"]
            forth = F.when(x["forth"].isNotNull(), F.struct(x["line"].alias("line"), *_named(x["forth"], levels, at(i))))
            new = ~F.get(p, begin)["forth"].eqNullSafe(x["back"])  # else it is what begins there
            back = F.when(x["back"].isNotNull() & new, F.struct((x["line"] + 1 - x["back"]).alias("line"), *_named(x["back"], levels, at(begin))))
            return F.array(forth, back)

        return F.array_compact(F.flatten(F.transform(p, two)))

    return rows.select(*_DOC, F.explode(_let(F.col("p"), runs)).alias("s")).select(*_DOC, "s.*")


def repeated_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, h1, h2, gone: the parts (begin, end) of each document, lines from 0, that repeat earlier runs; documents without any are left out.

    docs: as for named_runs(). Earlier is by (doc_id, h1, h2, line). Parts are in order, and apart.
    """
    spans = written(named_runs(docs, least), "runs")
    key = ["n", "own", "other"]
    firsts = written(spans.groupBy(*key).agg(F.min(F.struct(*_PLACE)).alias("first"), F.count("*").alias("times")).where("times > 1").drop("times"), "intervals")
    later = spans.join(firsts, key).where(F.struct(*_PLACE) > F.col("first")).select(*_DOC, F.col("line").alias("begin"), (F.col("line") + F.col("n") - 1).cast("int").alias("end"))
    by_doc = Window.partitionBy(*_DOC).orderBy("begin", "end")
    upto = F.max("end").over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    marked = later.withColumn("new", F.coalesce((F.col("begin") > upto + 1).cast("int"), F.lit(1))).withColumn("part", F.sum("new").over(by_doc))
    parts = marked.groupBy(*_DOC, "part").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    return parts.groupBy(*_DOC).agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("gone"))


def _left(lines: Column, gone: Column) -> Column:
    """The lines that are in none of those parts: each is looked at once."""

    def between(i: Column) -> Column:
        begin = F.coalesce(F.get(gone, i - 1)["end"] + 1, F.lit(0))
        return F.slice(lines, begin + 1, F.coalesce(F.get(gone, i)["begin"], F.size(lines)) - begin)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), between))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """docs without later copies of repeated runs of lines of ``least`` words or more, and deleted_lines (int).

    The first copy, by id and then by a hash of the text, stays; a null id comes first. Rows that
    agree in id and text count as one document and stay alike. All rows and columns stay: a text
    all of whose lines go becomes empty, and a null text stays null. Words are what white space
    parts; a line counts as one at least, also an empty one. Texts are shuffled once, by document;
    what else is shuffled are ids of lines.
    """
    rest = docs.drop("deleted_lines", "_id", "_h1", "_h2", "_gone")
    keyed = rest.withColumns({"_h1": F.xxhash64(text_col), "_h2": F.xxhash64(text_col, F.lit(7))})
    found = repeated_lines(keyed.select(F.col(id_col).alias("doc_id"), F.col("_h1").alias("h1"), F.col("_h2").alias("h2"), F.coalesce(text_col, F.lit("")).alias("text")), least)
    found = written(found.select(F.col("doc_id").alias("_id"), F.col("h1").alias("_g1"), F.col("h2").alias("_g2"), F.col("gone").alias("_gone")), "deleted")
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_h1") == F.col("_g1")) & (F.col("_h2") == F.col("_g2"))
    joined = keyed.join(found.hint("merge"), same, "left")  # one plan at every size
    kept = F.array_join(_let(F.split(text_col, "\n", -1), lambda x: _left(x, F.col("_gone"))), "\n")
    text = F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(kept)
    n = F.aggregate("_gone", F.lit(0), lambda s, x: s + x["end"] - x["begin"] + 1)
    return joined.withColumns({text_col: text, "deleted_lines": F.coalesce(n, F.lit(0))}).select(*rest.columns, "deleted_lines")


def deleted_sql(docs: str, least: int = LEAST) -> str:
    """DuckDB SQL for (doc_id, line) of the lines to delete from ``docs`` (a relation with distinct doc_id, and text):
    of every line, the shortest runs of enough words that begin and end there, compared as texts."""
    words = f"greatest(len(regexp_extract_all(own, '[^{_SPACE}]+')), 1)"
    return f"""
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS own, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line FROM {docs}),
sums AS (SELECT doc_id, line, own, sum({words}) OVER (PARTITION BY doc_id ORDER BY line) AS upto, {words} AS w FROM lines),
whole AS (SELECT doc_id, list(own ORDER BY line) AS own, list(upto ORDER BY line) AS upto, list(w ORDER BY line) AS w FROM sums GROUP BY doc_id),
ends AS (
  SELECT s.doc_id, s.line AS a, list_position(list_transform(whole.upto, lambda x: x - s.upto + s.w >= {least}), true) - 1 AS b FROM sums s JOIN whole USING (doc_id)
  UNION
  SELECT s.doc_id, len(list_filter(list_transform(whole.upto, lambda x, i: s.upto - x + whole.w[i] >= {least}), lambda x: x)) - 1 AS a, s.line AS b FROM sums s JOIN whole USING (doc_id)
),
runs AS (SELECT DISTINCT doc_id, a, b, array_to_string(own[a + 1 : b + 1], chr(10)) AS run FROM ends JOIN whole USING (doc_id) WHERE a >= 0 AND b >= a),
later AS (SELECT doc_id, a, b FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, a) AS k FROM runs) WHERE k > 1)
SELECT DISTINCT doc_id, unnest(generate_series(a, b)) AS line FROM later"""


def dedup_sql(least: int = LEAST) -> str:
    """DuckDB SQL for op8 over documents."""
    return f"""
WITH gone AS ({deleted_sql("documents", least)}),
sets AS (SELECT doc_id, list(line) AS lines FROM gone GROUP BY doc_id),
kept AS (SELECT doc_id, coalesce(len(lines), 0)::INTEGER AS deleted_lines,
  CASE WHEN lines IS NULL THEN text ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(lines, i - 1)), chr(10)) END AS text FROM documents LEFT JOIN sets USING (doc_id))
SELECT doc_id, deleted_lines, length(text)::INTEGER AS n_chars, md5(text) AS text_md5 FROM kept"""
