"""Language identification by Bayesian fusion of text, declared language, address suffix and host.

Text gives likelihoods: a naive Bayes model of hashed byte trigrams and whole
words, counted per declared language over the whole training table. The
declared language and the address suffix give likelihoods from counted
confusion tables. The host gives the prior: counts per host are smoothed
towards those of its domain, and these towards the whole corpus.
"""

from __future__ import annotations

import html
import re
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelab.llm.common import chunks, pick, starts_of, stored

#: Hashed trigram features; the model is languages x FEATURES numbers, whatever the corpus.
BITS = 16
FEATURES = 1 << BITS
#: Languages whose rows of the text model are held at a time; all declared ones are kept.
SHARD = 64
#: Pseudo-counts of the smoothing: a host counts as so many pages of its domain, a domain of the corpus.
HOST_WEIGHT, DOMAIN_WEIGHT = 20.0, 20.0
#: Trigrams of one text overlap and repeat: their log likelihood is scaled to at most so many independent ones.
MOST_TRIGRAMS = 60.0
#: A text with fewer letters than this has no language of its own.
LEAST_LETTERS = 1
#: Below this posterior the language is undetermined.
LEAST_POSTERIOR = 0.5

# Byte classes. Letters in lower case stay, all other ASCII becomes a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_LANG_ATTR = re.compile(r"<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})", re.IGNORECASE)
_META_LANG = re.compile(r"<meta\b[^>]*?http-equiv\s*=\s*[\"']?content-language[\"']?[^>]*?content\s*=\s*[\"']?([A-Za-z]{2,3})", re.IGNORECASE)
_DROPPED = re.compile(r"<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>", re.IGNORECASE | re.DOTALL)


def declared_language(page: str | None) -> str | None:
    """Language that the markup declares, in lower case."""
    found = _LANG_ATTR.search(page or "") or _META_LANG.search(page or "")
    return found[1].lower() if found else None


def visible_text(page: str | None) -> str:
    return html.unescape(_DROPPED.sub(" ", page or ""))


def trigram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of all texts in a row, and where each text starts."""
    folded = [b" " + b" ".join(t.encode("utf-8", "replace").translate(_FOLD).split()) + b"   " for t in texts]
    starts = starts_of(map(len, folded))
    data = np.frombuffer(b"".join(folded) + b"  ", np.uint8).astype(np.uint32)
    code = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    code = (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    blank = (data[:-2] == 32) & (data[1:-1] == 32)
    code[blank] = FEATURES  # no trigram
    return code, starts


def _sparse(lang: str, sums: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(sums)
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(sums[at].astype(np.int64))], names=["lang", "feature", "n"])


def _counts(batches, column_language: str):
    """Trigram counts per language within one task."""
    held: dict[str, np.ndarray] = {}
    for batch in chunks(batches):
        languages = batch.column(column_language).to_pylist()
        code, starts = trigram_codes([t or "" for t in batch.column("text").to_pylist()])
        for lang in set(languages) - {None}:
            own = [code[starts[i] : starts[i + 1]] for i, x in enumerate(languages) if x == lang]
            sums = np.bincount(np.concatenate(own), minlength=FEATURES + 1)[:FEATURES]
            held[lang] = held[lang] + sums if lang in held else sums
            if len(held) > SHARD:
                yield from map(_sparse, held, held.values())
                held = {}
    yield from map(_sparse, held, held.values())


def fit_text_model(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and log likelihoods (languages x features), counted over all rows with a declared language.

    Counts are added within tasks, then by Spark per language and feature, and
    stored. The model is made ``SHARD`` languages at a time, in a file if there are more.
    """
    rows = pick(docs, text=text, lang=lang).withColumn("lang", F.lower("lang")).where("lang IS NOT NULL")
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not languages:
        return [], np.zeros((0, FEATURES + 1), np.float32)
    counted = rows.mapInArrow(lambda b: _counts(b, "lang"), "lang string, feature int, n long")
    packed = counted.groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    shards = [languages[low : low + SHARD] for low in range(0, len(languages), SHARD)]
    if len(shards) > 1:
        packed = stored(packed, "trigrams")

    def logs(shard: list[str]) -> np.ndarray:
        table = np.zeros((len(shard), FEATURES), np.float64)
        number = {x: i for i, x in enumerate(shard)}
        for part in packed.where(F.col("lang").isin(shard)).toArrow().to_batches():
            at = [number[x] for x in part.column("lang").to_pylist()]
            table[at, part.column("feature").to_numpy()] = part.column("n").to_numpy()
        table += 0.5
        return np.log(table / table.sum(axis=1, keepdims=True))

    if len(shards) == 1:
        model = logs(languages)
        model -= model.mean(axis=0)  # only differences between languages count; keeps sums small
        return languages, np.hstack([model, np.zeros((len(languages), 1))]).astype(np.float32)
    mean = sum(logs(shard).sum(axis=0) for shard in shards) / len(languages)
    model = np.memmap(tempfile.TemporaryFile(), np.float32, "w+", shape=(len(languages), FEATURES + 1))
    for k, shard in enumerate(shards):
        model[k * SHARD : k * SHARD + len(shard), :FEATURES] = logs(shard) - mean
    return languages, model


def text_evidence(texts: list[str], model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled log likelihoods (texts x languages) and the number of trigrams of each text."""
    code, starts = trigram_codes(texts)
    n = np.add.reduceat((code != FEATURES).astype(np.int64), starts[:-1]) if len(texts) else np.zeros(0, np.int64)
    sums = np.stack([np.add.reduceat(row[code], starts[:-1], dtype=np.float64) for row in model], 1) if len(texts) and len(model) else np.zeros((len(texts), len(model)))
    return sums * np.minimum(1.0, MOST_TRIGRAMS / np.maximum(n, 1))[:, None], n


def letters(text: str) -> bool:
    return sum(map(str.isalpha, text[:200])) >= LEAST_LETTERS or any(map(str.isalpha, text))


def with_evidence(rows: DataFrame, languages: list[str], model: np.ndarray, page: bool = False) -> DataFrame:
    """``evidence`` (log likelihood per language) and ``worded`` beside the columns; of a page, its visible text and ``declared``."""
    added = [T.StructField("evidence", T.ArrayType(T.DoubleType())), T.StructField("worded", T.BooleanType())]
    if page:
        added.append(T.StructField("declared", T.StringType()))
    lows = range(0, max(1, len(languages)), SHARD)
    given = rows.schema.fields
    for low in lows:
        # At most SHARD x FEATURES floats: 17 MB. Further shards append to the evidence; the text goes with the last one.
        shared = rows.sparkSession.sparkContext.broadcast(np.array(model[low : low + SHARD]))
        kept = [f for f in given if not (page and f.name == "text" and low == lows[-1])]
        schema = T.StructType([*kept, *added])
        rows = rows.mapInArrow(_evidence(shared, kept, schema.names, page, low == 0), schema)
        if low != lows[-1]:
            rows = stored(rows, "evidence")
    return rows


def _evidence(shared, kept: list, names: list[str], page: bool, first: bool):
    def run(batches):
        for batch in chunks(batches):
            raw = batch.column("text").to_pylist()
            texts = [visible_text(t) if page else t or "" for t in raw]
            sums, _ = text_evidence(texts, shared.value)
            columns = [batch.column(f.name) for f in kept]
            if first:
                columns += [pa.array(list(sums), pa.list_(pa.float64())), pa.array([letters(t) for t in texts], pa.bool_())]
                if page:
                    columns.append(pa.array([declared_language(t) for t in raw], pa.string()))
            else:
                longer = [[*a, *b] for a, b in zip(batch.column("evidence").to_pylist(), sums.tolist())]
                columns += [pa.array(longer, pa.list_(pa.float64())), *[batch.column(c) for c in names[len(kept) + 1 :]]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def softmax(scores: Column) -> Column:
    top = F.array_max(scores)
    powers = F.transform(scores, lambda x: F.exp(x - top))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


def _vector_sum(column: str, n: int) -> list[Column]:
    return [F.sum(F.col(column)[i]).alias(f"s{i}") for i in range(n)]


def _total(columns: list[str]) -> Column:
    """Sum of the columns, in an expression that is no deeper for many of them."""
    return F.aggregate(F.array(*columns), F.lit(0.0), lambda a, b: a + b)


def _confusion(rows: DataFrame, column: str, n: int, weight: float = 5.0) -> DataFrame:
    """``column`` with the log likelihood of its value for each language, relative to that of the corpus."""
    sums = [f"s{i}" for i in range(n)]
    by_value = rows.where(F.col(column).isNotNull()).groupBy(column).agg(*_vector_sum("soft", n))
    total = [x or 0.0 for x in by_value.agg(*[F.sum(s) for s in sums]).first()]  # one number per language
    whole = sum(total) or 1.0
    own = _total(sums)
    rate = [F.log((F.col(f"s{i}") + weight * F.greatest(own, F.lit(1e-9)) / whole) / (t + weight)) for i, t in enumerate(total)]
    return by_value.select(F.col(column).alias(f"{column}_key"), F.array(*rate).alias(f"{column}_ll"))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def domain_of(host: Column) -> Column:
    """The last two labels of a host; the host itself if it has fewer."""
    return F.when(host.rlike(r"\.[^.]+\.[^.]+$"), F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)).otherwise(host)


def suffix_of(host: Column) -> Column:
    return F.regexp_extract(host, r"\.([^.]+)$", 1)


def fuse(rows: DataFrame, languages: list[str], name: str) -> DataFrame:
    """Posteriors from ``evidence``, ``declared``, ``suffix``, ``host``, ``domain``: adds lang_id, confidence, posterior.

    Counted tables have one row per distinct value and come from aggregates that
    combine before the shuffle; a host that holds a third of all rows is one row
    there. They are stored, so Spark knows their sizes: small ones are broadcast,
    large ones joined by a shuffle that adaptive execution can split.
    """
    n = len(languages)
    if not n:
        none = F.lit(None)
        return rows.withColumns({"lang_id": none.cast("string"), "confidence": F.lit(0.0), "posterior": F.lit(None).cast("map<string,double>")})
    given = {x: i for i, x in enumerate(languages)}
    first = rows.withColumn("soft", softmax(F.col("evidence")))
    hint = F.array(*[F.when(F.col("declared") == x, 1.0).otherwise(0.0) for x in given])
    first = first.withColumn("soft", softmax(F.zip_with("evidence", hint, lambda a, b: a + b)))
    keys = first.where("worded").select("soft", "declared", "suffix", "host", "domain")
    zero = F.array(*[F.lit(0.0)] * n)
    # Pre-aggregated once by all four keys: every further sum reads this table.
    cells = stored(keys.groupBy("declared", "suffix", "host", "domain").agg(*_vector_sum("soft", n)), f"{name}-cells")
    cells = cells.select("declared", "suffix", "host", "domain", F.array(*[F.col(f"s{i}") for i in range(n)]).alias("soft"))
    declared, suffix = _confusion(cells, "declared", n), _confusion(cells, "suffix", n)
    s = [f"s{i}" for i in range(n)]
    sums = [x or 0.0 for x in cells.agg(*[F.sum(F.col("soft")[i]) for i in range(n)]).first()]  # one number per language
    corpus = F.array(*[F.lit((x + 1.0) / (sum(sums) + n)) for x in sums])

    def level(by: str, above: Column, weight: float, joined: DataFrame) -> DataFrame:
        own = _total(s)
        return joined.withColumn(by, F.array(*[(F.col(x) + weight * above[i]) / (own + weight) for i, x in enumerate(s)])).drop(*s)

    domains = cells.where("domain IS NOT NULL").groupBy("domain").agg(*_vector_sum("soft", n))
    domains = level("domain_prior", corpus, DOMAIN_WEIGHT, domains)
    hosts = cells.where("host IS NOT NULL").groupBy("host", "domain").agg(*_vector_sum("soft", n)).join(domains, "domain")
    hosts = stored(level("prior", F.col("domain_prior"), HOST_WEIGHT, hosts).select(F.col("host").alias("host_key"), "prior"), f"{name}-hosts")
    out = rows.join(stored(declared, f"{name}-declared"), F.col("declared") == F.col("declared_key"), "left")
    out = out.join(stored(suffix, f"{name}-suffix"), F.col("suffix") == F.col("suffix_key"), "left")
    out = out.join(hosts, F.col("host") == F.col("host_key"), "left")
    score = F.transform(F.coalesce(F.col("prior"), corpus), lambda p: F.log(p))
    for part in ("evidence", "declared_ll", "suffix_ll"):
        score = F.zip_with(score, F.coalesce(F.col(part), zero), lambda a, b: a + b)
    out = out.withColumn("_p", softmax(score))
    best = F.array_max("_p")
    names = F.array(*[F.lit(x) for x in languages])
    sure = F.col("worded") & (best >= LEAST_POSTERIOR)
    out = out.withColumns(
        {
            "lang_id": F.when(sure, names[F.array_position("_p", best).cast("int") - 1]),
            "confidence": F.when(F.col("worded"), best).otherwise(0.0),
            "posterior": F.map_from_arrays(names, "_p"),
        }
    )
    return out.drop("_p", "declared_key", "suffix_key", "host_key", "declared_ll", "suffix_ll", "prior")


def identify_pages(pages: DataFrame, training: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per page: page_id, url, declared, host, lang_id (null: undetermined), confidence, posterior.

    ``training`` has texts with a declared language (columns text, lang). A
    page without letters, null or empty, is undetermined with confidence 0. A
    missing url or declaration adds no evidence. Equal posteriors go to the
    language first in the alphabet. Every row gets a row.
    """
    languages, model = fit_text_model(training)
    rows = pick(pages, page_id=page_id, url=url, text=page)
    rows = with_evidence(rows, languages, model, page=True)
    host = F.col("host")
    rows = rows.withColumn("host", host_of(F.col("url"))).withColumn("host", F.when(host != "", host))
    rows = rows.withColumn("domain", domain_of(host)).withColumn("suffix", F.when(suffix_of(host) != "", suffix_of(host)))
    # Evidence is small beside the pages: stored once, read by the counts and by the join.
    rows = stored(rows, "page-evidence")
    return fuse(rows, languages, "pages").select("page_id", "url", "declared", "host", "lang_id", "confidence", "posterior")


def identify_documents(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """All columns of ``docs`` with ``lang_id`` and ``confidence``; the declared language is ``lang``, the host ``source``.

    The source's domain is its name without trailing digits. Undetermined (no
    letters, or no language with at least half of the posterior): lang_id null.
    A column of the table named like an added one keeps its place; the added
    ones come last.
    """
    languages, model = fit_text_model(docs, text, lang)
    names = docs.columns
    at = {k: names.index(v) for k, v in (("text", text), ("lang", lang), ("source", source))}
    plain = docs.toDF(*[f"_{i}" for i in range(len(names))])
    keyed = plain.withColumns({"text": F.col(f"_{at['text']}")})
    rows = with_evidence(keyed, languages, model).drop("text")
    host = F.col(f"_{at['source']}").cast("string")
    rows = rows.withColumns(
        {
            "declared": F.lower(F.col(f"_{at['lang']}")),
            "host": host,
            "domain": F.regexp_replace(host, r"\d+$", ""),
            "suffix": F.lit(None).cast("string"),
        }
    )
    found = fuse(rows, languages, "documents")
    return found.select(*[F.col(f"_{i}") for i in range(len(names))], "lang_id", "confidence").toDF(*names, "lang_id", "confidence")
