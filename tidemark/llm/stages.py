"""Stages of the corpus pipeline: each takes and, but for the last, returns the columns of ``documents``.

Null texts count as empty.  Columns beyond those of ``documents`` pass through
the filtering stages as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard, language, packing, pii, suffixes
from tidemark.llm.common import stored

#: Letters from which on a cosine at chance level says that a text is in no learned language.
LETTERS_TO_TELL = 100


#: Bytes of an Arrow batch that a stage's tasks exchange with Python; Spark's own bound is 64 MB, held on both sides.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def _small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by bytes: a stage's result is computed after its function returns, so the
    setting stays."""
    if spark.conf.get(_BATCH, None) is not None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def _with_text(found: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` with a new text and its length."""
    new = {"text": F.col(text), "n_chars": F.char_length(text).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return found.select(*(new[c].alias(c) if new.get(c) is not None else F.col(c) for c in docs.columns))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language.  Texts without a letter go, and texts of ``LETTERS_TO_TELL`` letters or more
    that are no closer to any language than chance; shorter ones cannot be told and stay.  A missing ``lang`` is filled
    in.  Without any labelled document every text with a letter stays."""
    _small_batches(spark)
    languages, prototypes = language.train(docs, F.lit(True))
    if not languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = language.predict(docs, languages, prototypes)
    letters = F.char_length(F.regexp_replace(F.coalesce("text", F.lit("")), r"[^\p{L}]", ""))
    kept = found.filter((F.col("__tm_lang") != language.UNDETERMINED)
                        & ((F.col("__tm_score") >= language.chance_level()) | (letters < LETTERS_TO_TELL)))
    return kept.select(*(F.coalesce("lang", "__tm_lang").alias("lang") if c == "lang" else F.col(c) for c in docs.columns))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of 5-word shingle Jaccard 0.8: the one with the smallest id (null last), of those the one
    with the smallest text hash.  Rows are linked by their texts alone: different texts under one id stay, copies without
    an id go.  Texts without a word are linked with nothing and stay."""
    _small_batches(spark)
    rows = stored(docs.withColumn("__tm_row", F.monotonically_increasing_id()), "numbered")
    groups = jaccard.join(rows, id="__tm_row", size=5, per_cent=80).select("__tm_row", "component_id")
    order = rows.select("__tm_row", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("hash"), "__tm_row").alias("order"))
    first = groups.join(order, "__tm_row").groupBy("component_id").agg(F.min("order").alias("first")).select("first.__tm_row")
    return rows.join(first, "__tm_row", "left_semi").select(*docs.columns)


def without_repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their strings of 200 bytes that stand elsewhere too; documents of which nothing is left go."""
    _small_batches(spark)
    found = suffixes.remove(docs)
    return _with_text(found.filter((F.col("__tm_removed") == 0) | (F.trim("__tm_kept") != "")), docs, "__tm_kept")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by the name of its kind."""
    _small_batches(spark)
    return _with_text(pii.detect(docs, pii.train(docs)), docs, "__tm_redacted")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of powers of two up to 1024 tokens, with their ids."""
    _small_batches(spark)
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
