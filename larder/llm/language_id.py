"""Language identification: family first, then one-versus-one linear SVMs inside the family."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.arrow import map_text, text_buffers
from larder.llm.ragged import mix
from larder.llm.sizes import small
from larder.session import settle

UNKNOWN = "und"
FEATURES = 1 << 11
SLICE_BYTES = 1 << 19  # text whose features are made at once; the n-grams take some fifty times as much
SAMPLE_PER_LANG = 1500  # expected training rows of a language
ITERATIONS = 40

#: Families of languages by ISO 639 code; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi", "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk", "baltic": "lt lv", "celtic": "br cy ga gd", "uralic": "et fi hu",
    "turkic": "az kk ky tr tt tk uz", "indic": "bn gu hi mr ne pa sa si ur", "iranian": "fa ku ps tg",
    "dravidian": "kn ml ta te", "semitic": "am ar he mt", "sinitic": "yue zh", "malayic": "id jv ms su tl",
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], lang)


@dataclass
class Linear:
    """A linear SVM: positive margins speak for ``yes``."""
    yes: str
    no: str
    weights: np.ndarray
    bias: float


@dataclass
class LanguageModel:
    """One-versus-one machines between families, and inside each family between its languages."""
    families: dict[str, list[str]]
    between: list[Linear]
    within: dict[str, list[Linear]]


def features(texts: pa.Array) -> np.ndarray:
    """Per text: square roots of the shares of hashed byte 1- to 4-grams of the lower-cased text, of length 1."""
    data, offsets = text_buffers(pc.utf8_lower(texts.fill_null("")))
    out = np.zeros((len(texts), FEATURES), np.float32)
    codes = data.astype(np.uint64)
    grams = [(mix(codes + np.uint64(1)) & np.uint64(FEATURES - 1)).astype(np.int64)]
    for n in range(2, 5):
        codes = codes[:-1] * np.uint64(257) + data[n - 1:] if len(codes) else codes
        grams.append((mix(codes + np.uint64(n)) & np.uint64(FEATURES - 1)).astype(np.int64))
    for row in range(len(texts)):
        low, high = offsets[row], offsets[row + 1]
        for n, gram in enumerate(grams, 1):
            if high - low >= n:
                out[row] += np.bincount(gram[low:high - n + 1], minlength=FEATURES)
    out = np.sqrt(out)
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norms > 0, norms, 1)


def training_sample(frame: DataFrame, per_lang: int, text: str, lang: str) -> DataFrame:
    """Rows with features and language, about ``per_lang`` different texts of each language, chosen by hash."""
    known = frame.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    spot = F.pmod(F.xxhash64(F.col(text)), F.lit(1 << 30))
    bounds = settle(known.groupBy(F.col(lang).alias("_lang")).agg(
        (F.lit(float(1 << 30)) * per_lang / F.count(F.lit(1))).alias("_bound")), "language-counts")
    chosen = (known.select(F.col(text).alias("_text"), F.col(lang).alias("_lang"), spot.alias("_spot"))
              .join(small(bounds, 64), "_lang").filter(F.col("_spot") < F.col("_bound"))
              .dropDuplicates(["_spot", "_lang"]).select("_text", "_lang"))

    def work(batch: pa.RecordBatch) -> dict:
        rows = features(batch.column("_text"))
        flat = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * FEATURES, rows.ravel())
        return {"_lang": batch.column("_lang"), "features": flat}

    return settle(map_text(chosen, work, "_lang string, features array<float>", "_text", limit=SLICE_BYTES), "language-sample")


def _svm(rows: DataFrame, yes: str, no: str) -> Linear:
    labelled = rows.select(F.when(F.col("_name") == yes, 1.0).otherwise(0.0).alias("label"), "features")
    model = LinearSVC(maxIter=ITERATIONS, regParam=1e-4, standardization=False).fit(labelled)
    return Linear(yes, no, model.coefficients.toArray().astype(np.float32), float(model.intercept))


def fit_language_model(frame: DataFrame, per_lang: int = SAMPLE_PER_LANG, text: str = "text",
                       lang: str = "lang") -> LanguageModel | None:
    """Fit the machines on a bounded sample of the labelled rows; None if there is no labelled text.

    ``per_lang`` bounds the expected number of sampled rows of a language. Only text and language are read.
    """
    sample = training_sample(frame, per_lang, text, lang)
    langs = sorted(r[0] for r in sample.select("_lang").distinct().collect())  # one row per language
    if not langs:
        return None
    families: dict[str, list[str]] = {}
    for name in langs:
        families.setdefault(family_of(name), []).append(name)
    vectors = sample.withColumn("features", array_to_vector(F.col("features").cast("array<double>")))
    to_family = F.create_map(*[F.lit(x) for f, members in families.items() for m in members for x in (m, f)])
    by_family = vectors.withColumn("_name", to_family[F.col("_lang")])
    between = [_svm(by_family.filter(F.col("_name").isin(a, b)), a, b) for a, b in combinations(sorted(families), 2)]
    by_lang = vectors.withColumnRenamed("_lang", "_name")
    within = {f: [_svm(by_lang.filter(F.col("_name").isin(a, b)), a, b) for a, b in combinations(members, 2)]
              for f, members in families.items()}
    return LanguageModel(families, between, within)


def _vote(x: np.ndarray, machines: list[Linear], names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Per row the name with the most votes (ties: the larger sum of margins) and a confidence from 0 to 1."""
    votes, margins = np.zeros((2, len(x), len(names)))
    for m in machines:
        margin = x @ m.weights + m.bias
        yes, no = names.index(m.yes), names.index(m.no)
        votes[:, yes] += margin > 0
        votes[:, no] += margin <= 0
        margins[:, yes] += margin
        margins[:, no] -= margin
    best = np.argmax(votes + 0.5 * np.tanh(margins / max(1, len(names))), axis=1)
    mean = margins[np.arange(len(x)), best] / max(1, len(names) - 1)
    return best, 1 / (1 + np.exp(-3 * mean)) if machines else np.ones(len(x))


def predict(texts: pa.Array, model: LanguageModel | None) -> tuple[list[str], np.ndarray]:
    langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    lettered = np.flatnonzero(pc.match_substring_regex(texts.fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False))
    if model is None or not len(lettered):
        return langs, scores
    x = features(texts.take(pa.array(lettered)))
    names = sorted(model.families)
    family, sure = _vote(x, model.between, names)
    for k, name in enumerate(names):
        at = np.flatnonzero(family == k)
        if len(at):
            members = model.families[name]
            best, inner = _vote(x[at], model.within[name], members)
            scores[lettered[at]] = sure[at] * inner
            for row, b in zip(lettered[at].tolist(), best.tolist()):
                langs[row] = members[b]
    return langs, scores


def identify_languages(frame: DataFrame, model: LanguageModel | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, ``lang_pred`` and ``score`` (0 to 1: how clearly family and language won).

    ``lang_pred`` is ``und`` with score 0 where the text is null, empty or has no letter, and everywhere if
    there is no model. The whole text is read, whatever its length. Null keys stay null, repeated rows each
    give a row, ties fall to the first name, other columns are left out.
    """
    shared = frame.sparkSession.sparkContext.broadcast(model)  # a few weights per pair of languages
    kind = frame.schema[key].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> dict:
        langs, scores = predict(batch.column(text), shared.value)
        return {key: batch.column(key), "lang_pred": langs, "score": scores}

    return map_text(frame.select(key, text), work, f"`{key}` {kind}, lang_pred string, score double", text, limit=SLICE_BYTES)


def keep_identified(frame: DataFrame, model: LanguageModel | None, min_score: float = 0.0, text: str = "text",
                    lang: str | None = None) -> DataFrame:
    """The rows of ``frame``, all columns, whose text has a language with a score of at least ``min_score``.

    If ``lang`` names a column, the predicted language stands in it where it was null. Null, empty and letterless texts
    go, and without a model all rows do. Repeated rows are judged alike, texts are read whole whatever their length,
    other columns pass as they are, and an empty table stays empty.
    """
    shared = frame.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> dict:
        langs, scores = predict(batch.column(text), shared.value)
        keep = pa.array((np.array(langs) != UNKNOWN) & (scores >= min_score))
        if lang:
            at = batch.schema.get_field_index(lang)
            filled = pc.fill_null(batch.column(at), pa.array(langs, batch.schema.field(at).type))
            batch = pa.RecordBatch.from_arrays([filled if k == at else c for k, c in enumerate(batch.columns)], batch.schema.names)
        return dict(enumerate(batch.filter(keep).columns))

    return map_text(frame, work, frame.schema, text, limit=SLICE_BYTES)
