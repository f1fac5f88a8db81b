"""Quality rules with cross-document line frequency, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorgraph.llm.rows import HASH, ID, TEXT, keyed, once
from sensorgraph.operators.storage import stored

SPACE = r"[ \t-\r]+"
SYMBOLS = r"[#*$%&|<>]"


def words_of(text: Column) -> Column:
    """Maximal runs without ASCII white space."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def normal_line(line: Column) -> Column:
    """A line as it is compared across documents: lower case, single spaces, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(line), SPACE, " "))


def repeated_window_words(words: Column, width: int = 3) -> Column:
    """Words covered by windows of ``width`` words that a text has at least twice, the first included."""

    def hashed(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - width)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))

    def covered(starts: Column) -> Column:
        after = lambda i: F.coalesce(F.get(starts, i + 1) - F.get(starts, i), F.lit(width))
        each = F.transform(starts, lambda p, i: F.least(F.lit(width), after(i)))
        return F.aggregate(each, F.lit(0).cast("long"), lambda total, n: total + n)

    def repeated(ordered: Column) -> Column:
        same = lambda i, j: F.coalesce(F.get(ordered, i)["h"] == F.get(ordered, j)["h"], F.lit(False))
        twice = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), lambda i: same(i, i - 1) | same(i, i + 1))
        return F.sort_array(F.transform(twice, lambda i: F.get(ordered, i)["p"]))

    def counted(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        found = once(once(ordered, repeated), covered)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(found)

    return F.when(F.size(words) < 2 * width - (width - 1), F.lit(0).cast("long")).otherwise(once(once(words, hashed), counted))


def base_rules(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """Counts of single documents and the hashes of their normalised lines, in one pass without a shuffle."""
    host = F.coalesce(F.col(host_col).cast("string"), F.lit(""))
    words = keyed(docs, id_col, text_col, host=host).select(
        "*", words_of(F.col(TEXT)).alias("words"), F.split(F.col(TEXT), "\n").alias("parts")
    )
    lines = F.filter(F.col("parts"), lambda line: line.rlike(r"[^ \t-\r]"))
    counted = words.select(
        ID,
        HASH,
        "host",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count(F.col(TEXT), F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        repeated_window_words(F.col("words")).alias("n_repeat_words"),
        lines.alias("lines"),
    )

    def compared(line: Column) -> Column:
        chars = F.length(F.regexp_replace(line, " ", "")).cast("long")
        return F.struct(F.xxhash64(line).alias("line"), chars.alias("chars"))

    return counted.select(
        *[c for c in counted.columns if c != "lines"],
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("lines", lambda line: once(normal_line(line), compared)).alias("lines"),
    )


def quality_verdicts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    most_docs: int = 20,
    most_removed: float = 0.5,
) -> DataFrame:
    """Per row: base counts, ``base_failed``, characters on frequent lines and ``kept``.

    A normalised line in more than ``most_docs`` distinct documents of one host is removed everywhere on that host. A
    document is rejected if it fails the base rules or if over ``most_removed`` of its characters go with removed lines.
    Null text has no words and fails the base rules; a null host is the host ""; a null id is one id; rows that repeat an
    id count as one document; an empty table gives no row. Columns of the input beside the three named ones are ignored.

    Texts are read once and never shuffled: what moves is one hash per line. The distinct count is combined before the
    shuffle and keyed by host, line and id, so neither a hot host nor a hot line meets in one task; the frequent lines
    are written before they are joined, which lets adaptive execution broadcast them or split a hot one.
    """
    return _judged(docs, id_col, text_col, host_col, most_docs, most_removed)[0].drop(HASH, "host").withColumnRenamed(ID, id_col)


def _judged(
    docs: DataFrame, id_col: str, text_col: str, host_col: str, most_docs: int, most_removed: float
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The verdicts with row key and host, the lines' hashes per row, and the frequent lines."""
    base = stored(base_rules(docs, id_col, text_col, host_col), "line-hashes")
    lines = base.select(ID, HASH, "host", F.inline("lines"))
    documents = F.count_distinct(F.coalesce(F.col(ID), F.lit(-(2**63))))
    frequent = lines.groupBy("host", "line").agg(documents.alias("n")).where(F.col("n") > most_docs)
    frequent = stored(frequent.select("host", "line"), "frequent-lines")
    # A repeated row brings its lines again, so the sum over a row and its host is divided by the number of such rows.
    copies = base.groupBy(ID, HASH, "host").agg(F.count("*").alias("copies"))
    removed = lines.join(frequent, ["host", "line"], "left_semi").groupBy(ID, HASH, "host").agg(F.sum("chars").alias("chars"))
    removed = _attach(removed, copies, "inner").select(ID, HASH, "host", (F.col("chars") / F.col("copies")).cast("long").alias("gone"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    gone = F.coalesce(F.col("gone"), F.lit(0).cast("long"))
    verdicts = _attach(base, removed).select(
        ID,
        HASH,
        "host",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        gone.alias("n_removed_chars"),
        (~failed & (gone <= most_removed * F.col("word_chars"))).alias("kept"),
    )
    return verdicts, base, frequent


def _attach(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """``left`` with the other columns of ``right``, matched by row and host."""
    names = {ID: f"{ID}_r", HASH: f"{HASH}_r", "host": "host_r"}
    right = right.withColumnsRenamed(names)
    same = F.col(ID).eqNullSafe(F.col(names[ID])) & (F.col(HASH) == F.col(names[HASH])) & (F.col("host") == F.col(names["host"]))
    return left.join(right, same, how).drop(*names.values())


def without_frequent_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    most_docs: int = 20,
    most_removed: float = 0.5,
) -> DataFrame:
    """The input with ``text`` less its frequent lines, ``n_removed_lines`` and ``kept`` as ``quality_verdicts`` has it.

    Rejected rows are marked, not dropped. Other lines stay as they are, blank ones included; null text stays null, and a
    text of frequent lines only becomes empty. Only the places of removed lines move to the texts.
    """
    verdicts, base, frequent = _judged(docs, id_col, text_col, host_col, most_docs, most_removed)
    key = [ID, HASH, "host"]
    # Places count lines that are not blank, as base_rules keeps them.
    lines = base.select(*key, F.posexplode("lines").alias("at", "of")).select(*key, "at", F.col("of.line").alias("line"))
    gone = lines.join(frequent, ["host", "line"], "left_semi").groupBy(*key).agg(F.collect_set("at").alias("__llm_gone"))
    gone = stored(gone, "removed-lines")
    kept = stored(verdicts.groupBy(*key).agg(F.bool_and("kept").alias("__llm_kept")), "kept")
    names = {ID: "__llm_id_r", HASH: "__llm_hash_r", "host": "__llm_host_r"}
    text = F.coalesce(F.col(text_col), F.lit(""))
    host = F.coalesce(F.col(host_col).cast("string"), F.lit(""))
    marked = docs.withColumns({ID: F.col(id_col).cast("long"), HASH: F.xxhash64(text), "__llm_host": host})
    for right in (gone, kept):
        right = right.withColumnsRenamed(names)
        same = F.col(ID).eqNullSafe(F.col(names[ID])) & (F.col(HASH) == F.col(names[HASH])) & (F.col("__llm_host") == F.col(names["host"]))
        marked = marked.join(right, same, "left").drop(*names.values())

    def left(parts: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(parts) - 1)
        full = F.filter(every, lambda i: F.get(parts, i).rlike(r"[^ \t-\r]"))
        places = once(full, lambda full: F.transform("__llm_gone", lambda k: F.get(full, k)))
        return F.array_join(F.transform(F.array_except(every, places), lambda i: F.get(parts, i)), "\n")

    changed = F.col("__llm_gone").isNotNull()
    return marked.withColumns(
        {
            text_col: F.when(changed, once(F.split(F.col(text_col), "\n"), left)).otherwise(F.col(text_col)),
            "n_removed_lines": F.when(changed, F.size("__llm_gone")).otherwise(0).cast("long"),
            "kept": F.col("__llm_kept"),
        }
    ).drop(ID, HASH, "__llm_host", "__llm_gone", "__llm_kept")
