"""Toxicity scores from a bidirectional gated recurrent network (``recurrent.py``) over all overlapping windows.

The network is trained in one task on a bounded sample of labelled texts, of
each label those with the smallest hashes, and sent to the tasks that score;
its size is fixed by its tables (about 1 MB).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import recurrent
from tidemark.llm.common import BLOCK_BYTES, blocks, table, text_buffers, text_or_empty

#: Bounds of the training sample: texts of label 1 and of label 0, and bytes of a training text.
TOXIC_SAMPLE, CLEAN_SAMPLE, SAMPLE_BYTES = 600, 2000, 3000
#: Scores from here on are predicted toxic.
THRESHOLD = 0.7


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, id: str = "doc_id", text: str = "text", label: str = "toxic",
        toxic: int = TOXIC_SAMPLE, clean: int = CLEAN_SAMPLE, most_bytes: int = SAMPLE_BYTES) -> bytes:
    """A trained network, as bytes, from labelled texts for which ``allowed`` (a condition on ``id``) holds.

    Labels other than 0 and 1, null ids and null texts teach nothing; a text
    with both labels teaches both.  The sample is picked from ids and hashes,
    then only its texts are read again and moved.
    """
    wanted = labels.select(F.col(id).alias("id"), F.col(label).cast("int").alias("y")).filter(F.col("y").isin(0, 1)).distinct()
    texts = docs.filter(F.col(id).isNotNull() & F.col(text).isNotNull() & allowed).select(F.col(id).alias("id"), F.col(text).alias("text"))
    hashed = texts.filter(F.octet_length("text") <= most_bytes).select("id", F.xxhash64("text").alias("h")).distinct()
    order = Window.partitionBy("y").orderBy(F.xxhash64("id", "h"), "id", "h")
    sample = (hashed.join(wanted, "id").withColumn("n", F.row_number().over(order))
              .filter(F.col("n") <= F.when(F.col("y") == 1, toxic).otherwise(clean)).select("id", "h", "y"))
    # at most toxic + clean rows: the one broadcast here, bounded by its parameters
    chosen = texts.withColumn("h", F.xxhash64("text")).join(F.broadcast(sample), ["id", "h"]).dropDuplicates(["id", "h", "y"])

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"id": [], "h": [], "y": [], "text": []}), *frames], ignore_index=True)
        rows = rows.sort_values(["y", "h", "id"], ignore_index=True)
        data, offsets = text_buffers(pa.array(rows["text"].tolist(), pa.string()))
        yield pd.DataFrame({"model": [recurrent.dump(recurrent.train(data, offsets, rows["y"].to_numpy(np.float64)))]})

    found = chosen.select("id", "h", "y", "text").repartition(1).mapInPandas(learn, "model binary").collect()
    return bytes(found[0]["model"]) if found else recurrent.dump(recurrent.new_model())


def _long(model: dict, data: np.ndarray, most: int) -> float:
    """The score of one long text, window by window in pieces of about ``most`` bytes; the same windows as of the whole."""
    at, best = 0, 0.0
    while True:
        end = at + most
        while True:
            while end < len(data) and recurrent.inside(data[end - 1:end + 1]).all():
                end += 1
            end = min(end, len(data))
            t = recurrent.tokens(data[at:end], np.array([0, end - at]))
            full = (int(t.count[0]) - recurrent.WINDOW) // recurrent.STEP + 1
            if end == len(data) or full > 0:
                break
            end += most
        if end == len(data):
            return max(best, float(recurrent.scores(model, t)[0]))
        keep = (full - 1) * recurrent.STEP + recurrent.WINDOW
        part = t.first(keep)
        best = max(best, float(recurrent.scores(model, part)[0]))
        at += int(t.start[full * recurrent.STEP])


def score(docs: DataFrame, model: bytes, text: str = "text", most: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``__tm_score``, from 0 to 1; map-only.

    The score is the largest of all windows of the whole text; a null text
    counts as empty, and one without a token has one window without tokens.
    Equal texts have equal scores up to rounding; rows are independent, and
    further columns are passed through.
    """
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = recurrent.load(shared.value)
        for batch in batches:
            for part in blocks(batch, len(names), most):
                data, offsets = text_buffers(part.column(len(names)))
                if part.num_rows == 1 and len(data) > most:
                    found = np.array([_long(m, data, most)])
                else:
                    found = recurrent.scores(m, recurrent.tokens(data, offsets))
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(len(names))), pa.array(found, pa.float64())], [*names, "__tm_score"])

    return docs.withColumn("__tm_text", text_or_empty(text)).mapInArrow(run, docs.schema.simpleString()[7:-1] + ", __tm_score double")


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents whose crc32 of the id as text leaves 1 modulo 3; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def op12(spark, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from labels of those not held out."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"), ~held_out())
    out = score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), F.col("__tm_score").alias("score"),
                      (F.col("__tm_score") >= THRESHOLD).cast("int").alias("predicted"))
