"""One query per operator over its whole table, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorgraph.llm.decontamination import find_passages, items_digest
from sensorgraph.llm.hard_negatives import hard_negatives
from sensorgraph.llm.jaccard_join import near_duplicate_classes
from sensorgraph.llm.language_id import document_rows, identify, page_rows
from sensorgraph.llm.packing import pack
from sensorgraph.llm.quality_rules import quality_verdicts, without_frequent_lines
from sensorgraph.llm.secret_scans import find_secrets, kind_count, spans_text
from sensorgraph.llm.sentence_dedup import ENDS, UNSPACED, remove_repeated_sentences
from sensorgraph.llm.suffix_dedup import remove_repeats
from sensorgraph.llm.token_counts import length_histogram, length_sums
from sensorgraph.llm import toxicity
from sensorgraph.llm.vector_codes import books_digest, compress, hex_code, label_errors
from sensorgraph.llm.warc import read_archives, write_archives
from sensorgraph.operators.storage import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_token_counts")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return length_sums(length_histogram(table(spark, folder, "documents")))


OP10_SQL = r"""
with rows as (
  select doc_id, coalesce(source, '') as host, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents),
windows as (
  select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as s
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from rows where len(w) >= 3)),
twice as (select doc_id, i from windows qualify count(*) over (partition by doc_id, s) >= 2),
covered as (
  select doc_id, count(distinct i + k) as n from twice, (select unnest([0, 1, 2]) as k) group by doc_id),
lines as (
  select doc_id, host, trim(regexp_replace(lower(x), '[ \t\n\x0b\f\r]+', ' ', 'g'), ' ') as x
  from (select doc_id, host, unnest(l) as x from rows)),
frequent as (select host, x from lines group by all having count(distinct doc_id) > 20),
removed as (
  select doc_id, sum(length(replace(x, ' ', '')))::bigint as n from lines join frequent using (host, x) group by doc_id),
counted as (
  select doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
         coalesce(covered.n, 0)::bigint as n_repeat_words, coalesce(removed.n, 0)::bigint as n_removed_chars
  from rows left join covered using (doc_id) left join removed using (doc_id))
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and 2 * n_removed_chars <= word_chars as kept
from counted
"""


@query("op10_quality_rules", OP10_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return quality_verdicts(table(spark, folder, "documents"))


OP10_TEXTS_SQL = rf"""
with verdicts as ({OP10_SQL}),
parts as (
  select doc_id, coalesce(source, '') as host, generate_subscripts(string_split(text, chr(10)), 1) as i,
         unnest(string_split(text, chr(10))) as part from documents),
normal as (
  select *, regexp_matches(part, '[^\x20\x09-\x0D]') as filled,
         trim(regexp_replace(lower(part), '[ \t\n\x0b\f\r]+', ' ', 'g'), ' ') as x from parts),
frequent as (select host, x from normal where filled group by all having count(distinct doc_id) > 20),
gone as (select doc_id, i from normal join frequent using (host, x) where filled),
left_over as (select doc_id, string_agg(part, chr(10) order by i) as t from normal anti join gone using (doc_id, i) group by doc_id)
select doc_id, case when n is null then text else coalesce(t, '') end as text, coalesce(n, 0)::bigint as n_removed_lines, kept
from documents join verdicts using (doc_id) left join left_over using (doc_id)
left join (select doc_id, count(*) as n from gone group by doc_id) using (doc_id)
"""


@query("op10_quality_rules_texts", OP10_TEXTS_SQL)
def op10_texts(spark: SparkSession, folder: str) -> DataFrame:
    return without_frequent_lines(table(spark, folder, "documents").select("doc_id", "text", "source")).drop("source")


OP3_SQL = r"""
with items as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
docs as (
  select doc_id, regexp_extract_all(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
phrases as (
  select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as s
  from (select item_id, w, least(10, len(w)) as n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i
        from items where len(w) > 0)),
places as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as s
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
        from docs, (select distinct n from phrases) where len(w) >= n)),
hits as (select doc_id, item_id, i, p.n from places p join phrases q on p.s = q.s and p.n = q.n),
words as (
  select doc_id, count(distinct k) as n from (select doc_id, unnest(range(i, i + n)) as k from hits) group by doc_id),
found as (
  select doc_id, count(*) as n, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids
  from (select distinct doc_id, item_id from hits) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(words.n, 0)::bigint as n_hit, coalesce(found.n, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(words.n, 0) > 0 as contaminated
from docs left join words using (doc_id) left join found using (doc_id)
"""


@query("op3_benchmark_decontamination", OP3_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        items_digest().alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op7_best_fit_packing")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))


OP4_SQL = """
with p as (
  select page_id, coalesce(html, '') as h, strlen(coalesce(html, '')) as n,
         min(page_id) over (partition by coalesce(html, '')) as first from pages)
select page_id, n::bigint as payload_bytes, sha256(h) as payload_digest,
       case when n >= 100 and first <> page_id then 'revisit' else 'response' end as record_type,
       case when n >= 100 and first <> page_id then first end as refers_to
from p
"""


@query("op4_warc", OP4_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    manifest = write_archives(table(spark, folder, "pages"), scratch_path(spark, "warc"))
    return read_archives(manifest).drop("url", "payload")


@query("op9_toxicity")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = toxicity.fit(documents, table(spark, folder, "labels"))
    return toxicity.score(documents, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op8_language_id")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Documents (``doc_id``) and pages (``page_id``) together: pages bring markup and addresses, documents the labels."""
    rows = document_rows(table(spark, folder, "documents")).unionByName(page_rows(table(spark, folder, "pages")))
    of = lambda kind: F.when(F.col("kind") == kind, F.col("id"))
    return identify(rows).select(
        of("document").alias("doc_id"), of("page").alias("page_id"), "host", "language", "confidence", F.col("accepted").alias("kept")
    )


@query("op6_suffix_array_dedup")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeats(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


OP2_SQL = rf"""
with rows as (
  select doc_id, text, regexp_extract_all(coalesce(text, ''), '[^{ENDS}]*[{ENDS}]+|[^{ENDS}]+') as l from documents),
parts as (
  select doc_id, generate_subscripts(l, 1) as i, unnest(l) as s from rows),
normal as (
  select doc_id, i, trim(regexp_replace(lower(s), '[ \t\n\x0b\f\r{ENDS}]+', ' ', 'g'), ' ') as s from parts),
counted as (
  select *, len(regexp_extract_all(s, '[{UNSPACED}]{{1,2}}|[^ {UNSPACED}]+')) as w from normal),
worded as (
  select *, row_number() over (partition by doc_id order by i) as p, sum(w) over (partition by doc_id order by i) as total
  from counted where w > 0),
windows as (
  select a.doc_id, a.p as p, b.p as q from worded a join worded b
  on a.doc_id = b.doc_id and b.p between a.p + 1 and a.p + 7 and b.total - a.total + a.w >= 8),
extents as (
  select doc_id, p, min(q) as q from windows group by doc_id, p
  union select doc_id, max(p), q from windows group by doc_id, q
  union select doc_id, p, p from worded where w >= 16),
runs as (
  select e.doc_id, min(x.i) as i, max(x.i) as j, string_agg(x.s, chr(10) order by x.p) as s
  from extents e join worded x on x.doc_id = e.doc_id and x.p between e.p and e.q group by e.doc_id, e.p, e.q
  union all
  select a.doc_id, a.i, b.i, a.s || chr(10) || b.s from counted a join counted b on a.doc_id = b.doc_id and b.i = a.i + 1
  where a.w + b.w >= 8 and (a.w = 0 or b.w = 0)),
again as (select doc_id, i, j from runs qualify row_number() over (partition by s order by doc_id, i) > 1),
gone as (select distinct doc_id, unnest(range(i, j + 1)) as i from again),
kept as (
  select doc_id, string_agg(s, '' order by i) as t from parts anti join gone using (doc_id, i) group by doc_id)
select doc_id, case when n is null then text else coalesce(t, '') end as text, coalesce(n, 0)::bigint as n_removed
from rows left join kept using (doc_id) left join (select doc_id, count(*) as n from gone group by doc_id) using (doc_id)
"""


@query("op2_substring_dedup", OP2_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeated_sentences(table(spark, folder, "documents").select("doc_id", "text"))


query("op2_substring_dedup_covering", OP2_SQL)(op2)  # its earlier name


OP5_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') as w from documents),
shingles as (
  select distinct doc_id, md5(array_to_string(w[i:i + 4], ' ')) as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as x, b.doc_id as y, count(*) as c
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (
  select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * c >= 75 * (p.n + q.n - c)),
both_ways as (select x, y from links union all select y, x from links),
reach as (select x as doc_id, y as other from both_ways union select r.doc_id, b.y from reach r join both_ways b on r.other = b.x)
select d.doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, least(d.doc_id, min(other)) as component_id
from documents d left join sizes using (doc_id) left join reach using (doc_id) group by d.doc_id
"""


@query("op5_jaccard_join", OP5_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_classes(table(spark, folder, "documents"))


def _codes_sql(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    views = {
        "kept": """select row_number() over (order by vec_id) as r, vec_id, label,
            list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings
            where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0""",
        "points": f"""select r, vec_id, label, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] as x
            from kept, (select unnest(range({parts})) as p)""",
        "book_0": f"select p, r - 1 as e, x as c from points where r <= {entries}",
    }
    for k in range(rounds + 1):
        views[f"far_{k}"] = f"""select r, p, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as d
            from points join book_{k} using (p)"""
        views[f"own_{k}"] = f"select * from far_{k} qualify row_number() over (partition by r, p order by d, e) = 1"
        if k < rounds:
            views[f"mean_{k}"] = f"""select p, e, list(floor(s::double / n)::bigint order by i) as c from (
                select p, e, i, sum(x[i]) as s, count(*) as n
                from own_{k} join points using (r, p), (select unnest(range(1, len(v) // {parts} + 1)) as i from (select v from kept limit 1))
                group by p, e, i) group by p, e"""
            views[f"book_{k + 1}"] = f"select p, e, coalesce(m.c, b.c) as c from book_{k} b left join mean_{k} m using (p, e)"
    views["coded"] = f"select r, string_agg(printf('%02x', e), '' order by p) as code, sum(d)::bigint as error from own_{rounds} group by r"
    views["digest"] = f"select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) as codebooks_sha256 from book_{rounds}"
    return "with " + ", ".join(f"{n} as ({v})" for n, v in views.items()) + """
        select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
        from kept join coded using (r), digest"""


@query("op11_vector_codes", _codes_sql())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    codes = compress(table(spark, folder, "embeddings"))
    return label_errors(codes.rows).select(
        F.col("id").alias("vec_id"), hex_code().alias("code"), "error", "label_error", F.lit(books_digest(codes.books)).alias("codebooks_sha256")
    )



@query("op12_secret_scans")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    found = find_secrets(table(spark, folder, "documents"))
    counts = [kind_count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(spans_text("base"), 256).alias("base_sha256"), spans_text("spans").alias("spans"))


OP13_SQL = """
with usable as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same,
         list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::bigint as score
  from usable a join usable b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
positives as (
  select anchor_id, id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
ranked as (
  select anchor_id, positive_id, id as negative_id, positive_score, score as negative_score,
         (row_number() over (partition by anchor_id, positive_id order by score desc, id))::int as rank
  from positives join scored using (anchor_id)
  where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from ranked where rank <= 5
"""


@query("op13_hard_negatives", OP13_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").withColumn("label", moved)
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)
