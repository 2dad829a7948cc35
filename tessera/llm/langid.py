"""Language identification in two steps: language family, then one-versus-one linear SVMs within it.

Features are hashed character trigrams of the lower-cased text, non-letters
as blanks, as shares of the text's trigrams, so a model's score of a text is
the mean of its trigrams' weights: one table look-up per character. Models
are trained on a bounded sample of labelled rows (``SAMPLE`` per language in
expectation, picked by a hash of the row), one group per model.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import by_text_size, drop_tables, map_slices, release_memory, wide_rows, written
from tessera.session import ship_package

SAMPLE = 600
BITS = 16
SCALE = 40.0
UNDETERMINED = "und"
#: Documents below this score are rejected by ``identified``.
MIN_SCORE = 0.1

# Language families by ISO 639-1 code; a code not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu se",
    "indo_aryan": "bn gu hi mr ne pa si ur",
    "iranian": "fa ku ps tg",
    "turkic": "az kk ky tr tt ug uz",
    "semitic": "am ar he mt",
    "dravidian": "kn ml ta te",
    "austronesian": "id jv mg ms su tl",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
_LETTER = re.compile(r"[^\W\d_]")
_table: list[np.ndarray] = []


def family(lang: str) -> str:
    return FAMILY_OF.get(lang, lang)


def _letters() -> np.ndarray:
    if not _table:
        _table.append(np.array([chr(i).isalpha() for i in range(0x30000)] + [False]))
    return _table[0]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature number of every trigram that holds a letter, and the index of its text."""
    lowered = [t.lower() for t in texts]
    points = np.frombuffer(("  ".join(lowered) + "  ").encode("utf-32-le"), np.uint32)
    table = _letters()
    points = np.where(table[np.minimum(points, len(table) - 1)], points, np.uint32(32))
    starts = np.cumsum([0] + [len(t) + 2 for t in lowered[:-1]])
    mixed = points[:-2] * np.uint32(0x9E3779B1) + points[1:-1] * np.uint32(0x85EBCA77) + points[2:] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    keep = np.flatnonzero(points[1:-1] != 32)  # its middle is a letter
    owner = np.searchsorted(starts, keep, "right") - 1
    return (mixed[keep] >> np.uint32(32 - BITS)).astype(np.int64), owner


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in by_text_size(batches, "text"):
        f, owner = trigrams(b["text"].tolist())
        key, n = np.unique(owner << BITS | f, return_counts=True)
        edge = np.searchsorted(key >> BITS, np.arange(len(b) + 1))
        rows = [(lang, (key[s:e] & ((1 << BITS) - 1)).astype(np.int32), (n[s:e] / n[s:e].sum() * SCALE).astype(np.float32))
                for lang, s, e in zip(b["lang"], edge[:-1], edge[1:], strict=True) if e > s]
        yield pd.DataFrame(rows, columns=["lang", "f", "v"])


def linear_svm(rows: list[tuple[np.ndarray, np.ndarray]], sign: np.ndarray, epochs: int = 12,
               c: float = 1.0, seed: int = 3) -> tuple[np.ndarray, float]:
    """Weights and bias of an L2-regularised hinge-loss classifier (dual coordinate descent)."""
    w, alpha, bias = np.zeros(1 << BITS), np.zeros(len(rows)), 0.0
    norm = [float(v @ v) + 1.0 for _, v in rows]
    per_class = {s: len(sign) / (2 * max((sign == s).sum(), 1)) for s in (-1.0, 1.0)}
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            f, v = rows[i]
            gradient = sign[i] * (w[f] @ v + bias) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), c * per_class[sign[i]])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                w[f] += step * v
                bias += step
                alpha[i] = new
    return w.astype(np.float32), bias


def _train(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["lang", "order"])
    model = group["model"].iloc[0]
    rows = [(np.asarray(f), np.asarray(v)) for f, v in zip(group["f"], group["v"], strict=True)]
    w, bias = linear_svm(rows, np.where(group["positive"], 1.0, -1.0))
    return pd.DataFrame({"model": [model], "weights": [w.tobytes()], "bias": [bias]})


def fit(labelled: DataFrame, sample: int = SAMPLE) -> dict:
    """Models from ``labelled(doc_id, text, lang)``: families against the rest, pairs of languages in a family.

    Rows with a null language or without a letter teach nothing. The only data
    on the driver are the language counts and one weight table per model.
    """
    spark = labelled.sparkSession
    ship_package(spark)
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return {"langs": [], "models": {}}
    rate = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, sample / counts[k])))])
    drawn = usable.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < rate[F.col("lang")] * 1_000_000)
    features = written(map_slices(drawn.select("lang", "text"), _features, "lang string, f array<int>, v array<float>")
                       .withColumn("order", F.xxhash64("f", "v")), "language-features")
    families = sorted({family(x) for x in langs})
    # (model, language, positive): families one against the rest, language pairs within a family
    roles = [(f"family {f}", x, family(x) == f) for f in families if len(families) > 1 for x in langs]
    roles += [(f"pair {a} {b}", x, x == a) for i, a in enumerate(langs) for b in langs[i + 1:]
              if family(a) == family(b) for x in (a, b)]
    models = {}
    if roles:
        plan = F.broadcast(spark.createDataFrame(roles, "model string, lang string, positive boolean"))
        trained = features.join(plan, "lang").groupBy("model").applyInPandas(
            _train, "model string, weights binary, bias double")
        models = {r["model"]: (np.frombuffer(bytes(r["weights"]), np.float32), r["bias"]) for r in trained.collect()}
    return {"langs": langs, "models": models}


def _decide(score: dict[str, np.ndarray], langs: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Language and confidence of ``n`` texts from the models' margins."""
    sure = lambda margin: 1 / (1 + np.exp(-4 * np.clip(margin, -30, 30)))
    families = sorted({family(x) for x in langs})
    if len(families) > 1:
        margin = np.stack([score[f"family {f}"] for f in families])
        best, sure_family = margin.argmax(0), sure(margin.max(0))
    else:
        best, sure_family = np.zeros(n, int), np.ones(n)
    lang, confidence = np.empty(n, object), np.zeros(n)
    for k, f in enumerate(families):
        own, here = [x for x in langs if family(x) == f], best == k
        votes, trust = np.zeros((len(own), n)), np.zeros((len(own), n))
        for i, a in enumerate(own):
            for j in range(i + 1, len(own)):
                p = sure(score[f"pair {a} {own[j]}"])
                votes[i] += p >= 0.5
                votes[j] += p < 0.5
                trust[i] += p
                trust[j] += 1 - p
        pick = (votes + trust / (len(own) + 1)).argmax(0)
        share = trust[pick, np.arange(n)] / max(len(own) - 1, 1) if len(own) > 1 else np.ones(n)
        lang[here] = np.array(own, object)[pick[here]]
        confidence[here] = (share * sure_family)[here]
    return lang, confidence


def _predict(held):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = held.value
        names = list(model["models"])
        table = np.stack([model["models"][m][0] for m in names]) if names else np.zeros((0, 1 << BITS), np.float32)
        for b in by_text_size(batches, "text"):
            texts = b["text"].fillna("").tolist()
            spoken = np.array([bool(_LETTER.search(t)) for t in texts])
            f, owner = trigrams(texts)
            n = np.maximum(np.bincount(owner, minlength=len(b)), 1)
            score = {m: np.bincount(owner, weights=row[f], minlength=len(b)) * (SCALE / n) + model["models"][m][1]
                     for m, row in zip(names, table, strict=True)}
            if model["langs"]:
                lang, sure = _decide(score, model["langs"], len(b))
                lang[~spoken], sure[~spoken] = UNDETERMINED, 0.0
            else:
                lang, sure = UNDETERMINED, 0.0
            yield pd.DataFrame({"doc_id": b["doc_id"], "lang_pred": lang, "score": sure}, index=b.index)
    return run


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (0 to 1) of every row, from the whole text alone.

    A text that is null or has no letter gets ``und`` and score 0; without any
    model (no labelled row) every text does. Repeated rows get equal results, a
    null doc_id stays null, other columns aren't read, no rows give no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    return map_slices(docs.select("doc_id", "text"), _predict(held), "doc_id long, lang_pred string, score double")


def is_held_out() -> Column:
    """True for the fold that is never trained on: crc32 of the doc_id's text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Trains on the rows outside the held-out fold and predicts all: ``doc_id, held_out, lang_pred, score``."""
    model = fit(docs.where(F.col("doc_id").isNotNull() & ~is_held_out()), sample)
    return predict(docs, model).select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score")


def identified(docs: DataFrame, min_score: float = MIN_SCORE, sample: int = SAMPLE) -> DataFrame:
    """``docs`` whose language is known: rejects ``und`` and scores below ``min_score``; all columns stay.

    The verdict is a column computed beside the rows, so equal rows fare alike
    whatever their doc_id.
    """
    model = fit(docs.where(F.col("doc_id").isNotNull() & ~is_held_out()), sample)
    held = docs.sparkSession.sparkContext.broadcast(model)
    @F.pandas_udf("lang_pred string, score double")
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        drop_tables()
        for out in _predict(held)(pd.DataFrame({"doc_id": 0, "text": t}) for t in texts):
            yield out[["lang_pred", "score"]]
        release_memory()

    ship_package(docs.sparkSession)
    wide_rows(docs.sparkSession)
    verdict = judge(docs["text"])  # only texts go to Python; the rows wait beside them
    return docs.where((verdict["lang_pred"] != UNDETERMINED) & (verdict["score"] >= min_score))
