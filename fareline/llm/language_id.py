"""Language identification by Bayesian evidence fusion.

Four kinds of evidence about a page's language multiply: the likelihood of its text (hashed trigrams of bytes, counted
for each language over all labelled documents), the language its markup declares (how often pages of a language declare
each code), and a prior of its host, which shrinks to that of its address suffix and that to the whole corpus. Declared
codes and priors are grouped aggregates of the text posteriors over all pages; a page's own share is taken out of its
host's counts before they judge it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareline.llm.shipping import ship
from fareline.llm.text import LOWER, Texts, mixed, slices
from fareline.llm.url_lists import host_of
from fareline.session import broadcast_if_small, pin

PLACES = 1 << 16
#: Trigrams of one text are far from independent: its log-likelihood counts with this power of their number.
TEXT_POWER = 0.5
#: Pages' worth of prior from the level above: corpus for a suffix, suffix for a host; and of a declared code.
SUFFIX_WEIGHT, HOST_WEIGHT, DECLARED_WEIGHT = 20.0, 5.0, 2.0
BROADCAST_ROWS = 200_000
_MARKUP = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>|&[a-z0-9#]+;"
_DECLARED = r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})"


def trigram_places(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The place of every trigram of lower-cased bytes inside a document, and the document of each."""
    data = LOWER[texts.data].astype(np.uint64)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (data[:-2] << np.uint64(16)) | (data[1:-1] << np.uint64(8)) | data[2:]
    document = np.repeat(np.arange(len(texts)), np.diff(texts.bounds))
    inside = document[:-2] == document[2:]
    return (mixed(code[inside]) % np.uint64(PLACES)).astype(np.int64), document[:-2][inside]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for part, texts in slices(batch, "__text"):
            places, document = trigram_places(texts)
            names, which = np.unique(part.column("__lang").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
            for k, name in enumerate(names.tolist()):
                at = np.bincount(places[which[document] == k], minlength=PLACES)
                counts[name] = counts[name] + at if name in counts else at
    for name, at in counts.items():
        some = np.flatnonzero(at)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some), pa.array(at[some])], names=["lang", "place", "n"])


def train(docs: DataFrame, lang: str = "lang", text: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages in order, and a log probability of each place for each; counts come from every labelled text.

    The model has a row of fixed size for each language, so the driver holds little whatever the corpus. Rows without
    a language or a text teach nothing.
    """
    rows = ship(docs).where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("__lang"), F.col(text).alias("__text"))
    counts = rows.mapInArrow(_counted, "lang string, place long, n long").groupBy("lang", "place").agg(F.sum("n").alias("n")).toArrow()
    names, row = np.unique(counts.column("lang").to_numpy().astype(str), return_inverse=True)
    table = np.full((len(names), PLACES), 0.5)
    table[row, counts.column("place").to_numpy()] += counts.column("n").to_numpy()
    return names.tolist(), np.log(table / table.sum(1, keepdims=True)).astype(np.float32)


def text_posteriors(rows: DataFrame, model: tuple[list[str], np.ndarray], text: str) -> DataFrame:
    """`rows` without the text, with `__likelihoods`: a normalised log-likelihood for each language, 0 without a text."""
    names, logs = model
    kept = ship(rows)
    schema = T.StructType([*[f for f in kept.schema if f.name != text], T.StructField("__likelihoods", T.ArrayType(T.DoubleType()))])
    shared = rows.sparkSession.sparkContext.broadcast(logs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = shared.value
        for batch in batches:
            for part, texts in slices(batch, text):
                places, document = trigram_places(texts)
                n = np.maximum(np.bincount(document, minlength=len(texts)), 1)
                found = np.column_stack([np.bincount(document, row[places], len(texts)) for row in logs]) / (n**(1 - TEXT_POWER))[:, None]
                found -= found.max(1, keepdims=True)
                held = pa.array(list(found), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in schema if f.name != "__likelihoods"), held], names=schema.names)

    return kept.mapInArrow(run, schema)


def _shares(logs: str) -> Column:
    """Probabilities from an array of log weights."""
    raw = F.transform(logs, F.exp)
    return F.transform(raw, lambda x: x / F.aggregate(raw, F.lit(0.0), lambda s, y: s + y))


def _sums(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The sum of `p` for each group, as an array: one partial row a task and group."""
    sums = rows.groupBy(*keys).agg(*[F.sum(F.get("__p", F.lit(k))).alias(f"s{k}") for k in range(n)])
    return sums.select(*keys, F.array(*[f"s{k}" for k in range(n)]).alias("sums"))


def identify(pages: DataFrame, model: tuple[list[str], np.ndarray], url: str = "url", html: str = "html") -> DataFrame:
    """`pages` without `html`, with `language`, `confidence`, `text_language`, `declared` and `suffix`.

    Null and empty pages have no text evidence and follow their host's prior; a page without a host follows the corpus,
    one without a declared code has no declared evidence. Of equal languages the first in order wins. A model without
    languages gives nulls. Columns of the added names are replaced; repeated rows have equal results.
    """
    names = model[0]
    added = ["language", "confidence", "text_language", "declared", "suffix"]
    kept = [c for c in pages.columns if c not in [*added, html]]
    text = F.regexp_replace(F.coalesce(F.col(html), F.lit("")), _MARKUP, " ")
    declared = F.lower(F.regexp_extract(F.coalesce(F.col(html), F.lit("")), _DECLARED, 1))
    rows = pages.withColumns({"__html": text, "declared": F.when(declared != "", declared), "__host": host_of(url)}).select(*kept, "declared", "__host", "__html")
    if not names:
        nothing = rows.withColumns({"language": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double"), "text_language": F.lit(None).cast("string")})
        return nothing.withColumn("suffix", F.substring_index("__host", ".", -1)).select(*kept, *added)
    rows = rows.withColumn("suffix", F.substring_index("__host", ".", -1))
    n = len(names)
    rows = pin(text_posteriors(rows, model, "__html").withColumn("__p", _shares("__likelihoods")))

    corpus = [float(x or 0) for x in (_sums(rows.withColumn("one", F.lit(1)), ["one"], n).select("sums").first() or [[0.0] * n])[0]]
    total = sum(corpus) or 1.0
    flat = F.array(*[F.lit((x + 1) / (total + n)) for x in corpus])
    suffixes = pin(_sums(rows.where("suffix is not null"), ["suffix"], n).withColumnRenamed("sums", "__suffix"))
    hosts = pin(_sums(rows.where("__host is not null"), ["__host"], n).withColumnRenamed("sums", "__sums"))
    # How pages of a language declare: for each code the sums of the posteriors, over those of all codes.
    codes = pin(_sums(rows.where("declared is not null"), ["declared"], n).withColumnRenamed("sums", "__codes"))
    all_codes = codes.agg(*[F.sum(F.get("__codes", F.lit(k))) for k in range(n)], F.count("*")).first()
    out = rows
    for part, key in ((suffixes, "suffix"), (hosts, "__host"), (codes, "declared")):
        out = out.join(broadcast_if_small(part, BROADCAST_ROWS), key, "left")
    zero = F.array(*[F.lit(0.0)] * n)
    less = lambda sums: F.zip_with(F.coalesce(sums, zero), F.when(F.col(sums).isNull(), zero).otherwise(F.col("__p")), lambda s, p: F.greatest(s - p, F.lit(0.0)))
    weight = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    out = out.withColumns({"__suffix": less("__suffix"), "__sums": less("__sums"), "__codes": less("__codes")})
    out = out.withColumn("__prior", F.zip_with("__suffix", flat, lambda s, q: s + SUFFIX_WEIGHT * q))
    out = out.withColumn("__prior", F.transform("__prior", lambda x: x / (weight(F.col("__suffix")) + SUFFIX_WEIGHT)))
    out = out.withColumn("__prior", F.zip_with("__sums", "__prior", lambda s, q: s + HOST_WEIGHT * q))
    out = out.withColumn("__prior", F.transform("__prior", lambda x: x / (weight(F.col("__sums")) + HOST_WEIGHT)))
    n_codes = max(1, all_codes[n] or 0)
    of_all = F.array(*[F.lit(float(all_codes[k] or 0)) for k in range(n)])
    says = F.zip_with("__codes", of_all, lambda s, a: (s + DECLARED_WEIGHT / n_codes) / (a + DECLARED_WEIGHT))
    says = F.when(F.col("declared").isNull(), F.array(*[F.lit(1.0)] * n)).otherwise(says)
    out = out.withColumn("__says", says)
    fused = F.transform(F.arrays_zip("__likelihoods", "__prior", "__says"), lambda x: x["__likelihoods"] + F.log(x["__prior"]) + F.log(x["__says"]))
    out = out.withColumn("__fused", fused).withColumn("__fused", F.transform("__fused", lambda x: x - F.array_max("__fused")))
    out = out.withColumn("__fused", _shares("__fused"))
    named = F.array(*[F.lit(x) for x in names])
    top = lambda a: F.get(named, F.array_position(a, F.array_max(a)).cast("int") - 1)
    return out.withColumns(
        {"language": top(F.col("__fused")), "confidence": F.array_max("__fused"), "text_language": top(F.col("__likelihoods"))}
    ).select(*kept, *added)
