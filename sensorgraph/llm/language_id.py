"""Language identification that fuses text, declared markup language, address suffix and host priors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorgraph.llm.rows import small_batches
from sensorgraph.llm.text import LOWER, byte_column, pieces
from sensorgraph.operators.storage import stored

#: Byte trigrams are counted in this many cells.
CELLS = 1 << 16
#: Expected number of labelled texts per language that the text model is fitted on, drawn by hash of the id.
SAMPLE_TEXTS = 2000
#: Languages with a text model, those with most labelled texts; a model takes 256 KB on the driver and per worker.
MOST_LANGUAGES = 512
#: A text counts as at most so many independent trigrams: neighbours overlap, so long texts would be too sure.
TEXT_WEIGHT = 120
#: Pseudo-counts with which a level of the address (suffix, domain, host) leans on the level above.
HOST_SMOOTHING, MARKUP_SMOOTHING = 5.0, 2.0


def _cells(data: np.ndarray) -> np.ndarray:
    b = LOWER[data].astype(np.uint32)
    return ((b[:-2] * 0x9E3779B1 + b[1:-1] * 0x85EBCA6B + b[2:] * 0xC2B2AE35) >> 13) & (CELLS - 1)


def _owners(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the first trigram and the number of trigrams that lie within it."""
    return offsets[:-1], np.maximum(np.diff(offsets) - 2, 0)


def fit_text(rows: DataFrame, languages: list[str], totals: dict[str, int]) -> np.ndarray:
    """Log probability of each trigram cell per language, from a drawn sample of labelled texts."""
    shares = [(name, k, min(1.0, SAMPLE_TEXTS / totals[name])) for k, name in enumerate(languages)]
    shares = F.broadcast(rows.sparkSession.createDataFrame(shares, "lang string, which int, share double"))
    lot = F.pmod(F.xxhash64("id", "text"), F.lit(1_000_000))
    drawn = rows.join(shares, "lang").where(lot < F.col("share") * 1_000_000).select("which", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = byte_column(batch.column(1))
            which = batch.column(0).to_numpy().astype(np.int64)
            for a, b in pieces(offsets):
                part = data[offsets[a] : offsets[b]]
                _, n = _owners(offsets[a : b + 1])
                owner = np.repeat(np.arange(a, b), n)
                inside = np.repeat(offsets[a:b] - offsets[a], n) + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
                if len(owner):
                    found, times = np.unique(which[owner] * CELLS + _cells(part)[inside], return_counts=True)
                    columns = [pa.array((found // CELLS).astype(np.int32)), pa.array((found % CELLS).astype(np.int32)), pa.array(times)]
                    yield pa.record_batch(columns, ["which", "cell", "n"])

    counted = drawn.mapInArrow(count, "which int, cell int, n long").groupBy("which", "cell").agg(F.sum("n").alias("n"))
    table = np.full((CELLS, len(languages)), 0.5, np.float32)
    found = counted.toArrow()  # at most CELLS rows per language
    table[found["cell"].to_numpy(), found["which"].to_numpy()] += found["n"].to_numpy()
    return np.log(table / table.sum(0, dtype=np.float64).astype(np.float32))


def _text_scores(rows: DataFrame, model: np.ndarray, languages: list[str]) -> DataFrame:
    """The rows without their text, with ``n`` trigrams and ``ll``: log likelihoods per language, the best one 0."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            data, offsets = byte_column(batch.column(0))
            for a, b in pieces(offsets):
                part = data[offsets[a] : offsets[b]]
                first, n = _owners(offsets[a : b + 1] - offsets[a])
                score = np.zeros((b - a, table.shape[1]))
                if len(part) > 2:
                    cells = _cells(part)
                    for k in range(table.shape[1]):
                        sums = np.concatenate(([0.0], np.cumsum(table[:, k][cells], dtype=np.float64)))
                        low = np.minimum(first, len(cells))
                        score[:, k] = sums[np.minimum(low + n, len(cells))] - sums[low]
                score *= (np.minimum(n, TEXT_WEIGHT) / np.maximum(n, 1))[:, None]
                score -= score.max(1, keepdims=True)
                more = [batch.column(k + 1).slice(a, b - a) for k in range(len(keep))]
                lists = pa.ListArray.from_arrays(np.arange(b - a + 1, dtype=np.int32) * table.shape[1], score.ravel())
                yield pa.record_batch([*more, pa.array(n), lists], [*keep, "n", "ll"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields)
    return rows.select("text", *keep).mapInArrow(run, f"{kinds}, n long, ll array<double>")


def markup_language(html: Column) -> Column:
    """The two-letter language that a page declares on its root element, null if none."""
    found = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2})", 1))
    return F.when(found != "", found)


def page_text(html: Column) -> Column:
    return F.regexp_replace(html, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>", " ")


def address_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, registered domain (its last two labels) and suffix (last label, or a two-letter first path part)."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    path = F.lower(F.regexp_extract(url, r"://[^/?#]+/([a-zA-Z]{2})(?:[/?#]|$)", 1))
    domain = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    last = F.regexp_extract(host, r"([^.]+)$", 1)
    none = lambda c: F.when(c != "", c)
    return none(host), none(domain), F.coalesce(none(path), none(last))


def _named(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often an inner lambda uses it."""
    return F.transform(F.array(value), body)[0]


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _numbers(values) -> Column:
    return F.array(*[F.lit(float(x)) for x in values])


def _posterior(terms: Column) -> Column:
    scaled = _named(F.array_max(terms), lambda top: F.transform(terms, lambda x: F.exp(x - top)))
    return _named(scaled, lambda all_of: _named(_total(all_of), lambda total: F.transform(all_of, lambda x: x / total)))


def _sums(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Sum of the posteriors of a group, as one array; languages are summed as rows, before they are shuffled."""
    parts = rows.select(*keys, F.posexplode("p").alias("k", "x")).groupBy(*keys, "k").agg(F.sum("x").alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("k", "x")))
    return parts.groupBy(*keys).agg(F.transform(ordered, lambda e: e["x"]).alias(name))


def _sum_of_all(rows: DataFrame, size: int) -> np.ndarray:
    found = _sums(rows, [], "total").first()["total"]
    return np.array(found) if found else np.zeros(size)


def identify(
    rows: DataFrame,
    least_confidence: float = 0.5,
    wanted: list[str] | None = None,
    most_languages: int = MOST_LANGUAGES,
) -> DataFrame:
    """Rows ``id, kind, text, lang, host, domain, suffix, markup`` to ``id, kind, host, language, confidence, accepted``.

    ``lang`` labels the texts that the trigram model is fitted on and is used for nothing else; the model covers the
    ``most_languages`` values with most labelled texts (ties by name), all rows are judged among these. The posterior is the
    product of the text likelihood, the likelihoods of the declared language and of the address suffix given the
    language, and the prior of the host. Those three are estimated from the text posteriors of all rows by grouped sums:
    host leans on domain, domain on all rows, each with pseudo-counts; a row's own posterior is taken out of its host.

    Null and empty texts have no text evidence, any other evidence may be null and then says nothing; such rows get the
    most likely language but are not accepted, as are those below ``least_confidence`` or outside ``wanted``. Repeated
    rows each give a row; without labelled texts the language is null; an empty table gives no row. Only narrow rows
    are shuffled; the grouped tables are written, so that a hot host's join is broadcast or split.
    """
    small_batches(rows.sparkSession)
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    labels = rows.where(F.col("lang").isNotNull() & (F.col("text") != "")).groupBy("lang").count()
    totals = {r["lang"]: r["count"] for r in labels.orderBy(F.desc("count"), "lang").limit(most_languages).collect()}
    languages = sorted(totals)
    if not languages:
        return rows.select(
            "id", "kind", "host", F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("confidence"), F.lit(False).alias("accepted")
        )
    size = len(languages)
    scored = _text_scores(rows.drop("lang"), fit_text(rows, languages, totals), languages)
    scored = stored(scored.withColumn("p", _posterior(F.col("ll"))), "text-scores")
    known = scored.where("n > 0")
    world = _sum_of_all(known, size) + 1.0
    world = world / world.sum()
    evidence = scored
    for name in ("markup", "suffix"):  # P(declared | language), with pseudo-counts in proportion to all rows
        value = known.where(F.col(name).isNotNull())
        all_of = _sum_of_all(value, size)
        general = _total(F.col("in_group")) * (MARKUP_SMOOTHING / max(all_of.sum(), 1e-9))
        below = _numbers(all_of + MARKUP_SMOOTHING)
        terms = _named(general, lambda g: F.zip_with("in_group", below, lambda x, n: F.log((x + g) / n)))  # noqa: B023
        per = stored(_sums(value, [name], "in_group").select(name, terms.alias(f"ll_{name}")), f"{name}-likelihood")
        evidence = evidence.join(per, name, "left")
    by_domain = stored(_sums(known.where("domain is not null"), ["domain"], "in_domain"), "domains")
    by_host = stored(_sums(known.where("host is not null"), ["host"], "in_host"), "hosts")
    evidence = evidence.join(by_domain, "domain", "left").join(by_host, "host", "left")
    nothing = F.array_repeat(F.lit(0.0), size)

    def leaned(counts: str, above: Column) -> Column:
        """Shares of a level without the row itself, smoothed by the level above."""
        own = F.when(F.col("n") > 0, F.col("p")).otherwise(nothing)
        others = F.zip_with(F.coalesce(F.col(counts), own), own, lambda a, x: F.greatest(a - x, F.lit(0.0)))
        share = lambda left, total: F.zip_with(left, above, lambda a, x: (a + HOST_SMOOTHING * x) / total)
        return _named(others, lambda left: _named(_total(left) + HOST_SMOOTHING, lambda total: share(left, total)))

    evidence = evidence.withColumn("domain_share", leaned("in_domain", _numbers(world)))
    evidence = evidence.withColumn("host_share", leaned("in_host", F.col("domain_share")))
    terms = F.zip_with("ll", "host_share", lambda a, x: a + F.log(x))
    for name in ("markup", "suffix"):
        terms = F.zip_with(terms, F.coalesce(F.col(f"ll_{name}"), nothing), lambda a, x: a + x)
    fused = evidence.withColumn("posterior", _posterior(terms))
    best = F.array_max("posterior")
    language = F.get(F.array(*[F.lit(x) for x in languages]), (F.array_position("posterior", best) - 1).cast("int"))
    accepted = (F.col("n") > 0) & (F.col("confidence") >= least_confidence)
    if wanted is not None:
        accepted = accepted & F.col("language").isin(wanted)
    found = fused.select("id", "kind", "host", "n", language.alias("language"), best.alias("confidence"))
    return found.select("id", "kind", "host", "language", "confidence", accepted.alias("accepted"))


def document_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Documents as rows for ``identify``: the source is their host, they declare nothing."""
    none = F.lit(None).cast("string")
    return docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.lit("document").alias("kind"),
        F.col(text_col).alias("text"),
        F.col("lang").cast("string").alias("lang"),
        F.col(host_col).cast("string").alias("host"),
        none.alias("domain"),
        none.alias("suffix"),
        none.alias("markup"),
    )


def page_rows(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    host, domain, suffix = address_parts(F.col(url_col))
    return pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.lit("page").alias("kind"),
        page_text(F.col(html_col)).alias("text"),
        F.lit(None).cast("string").alias("lang"),
        host.alias("host"),
        domain.alias("domain"),
        suffix.alias("suffix"),
        markup_language(F.col(html_col)).alias("markup"),
    )
