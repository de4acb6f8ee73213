"""From raw documents to token files: toxicity, near duplicates, benchmark passages, the mix of sources, token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlake.llm import containment, dac, minhash, mixing, toxicity
from firmlake.llm.common import without_ids
from firmlake.llm.queries import bucket_of, table, tokenizer_file
from firmlake.session import drop_path, drop_stored, scratch_paths, write_and_read

_held: list[str] = []  # what the stage before has stored for its own result


def _stage(function: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """A stage whose stored steps go when the next one begins, as its result is a table of its own by then.

    Steps that ``docs`` still reads, because the result was not stored, stay until the session ends; so do those of the last
    stage, whose result may still be read when another run begins.
    """

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if _held and function.__name__ != drop_toxic.__name__:
            read = docs.inputFiles()
            for path in _held:
                if not any(path.rpartition("/")[2] in file for file in read):  # names are unique
                    drop_path(spark, path)
        before = len(scratch_paths())
        result = function(spark, docs, sf_dir)
        _held[:] = scratch_paths()[before:]
        return result

    return run


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, learnt from the labels, does not reject. A null text is scored like an empty one."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(bucket_of("doc_id", 3) != 1))
    return docs.where(~toxicity.is_toxic(model, F.col("text")))


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group; rows without doc_id or without words stay."""
    found = write_and_read(minhash.near_duplicates(docs, words=5, percent=80), "near-duplicates")
    gone = write_and_read(found.where("component_id is not null and not kept").select("doc_id").distinct(), "gone")
    return without_ids(docs, "doc_id", gone)


@_stage
def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item. Null and empty texts contain none and stay."""
    return docs.where(~containment.contains_any(table(spark, sf_dir, "benchmark"), F.col("text")))


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Null texts have no words, a null source is a source of its own."""
    return mixing.mixed(docs)


@_stage
def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each row, read back from the token files."""
    return dac.read_tokens(dac.write_tokens(docs, tokenizer_file())).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]

#: SQL expresses neither the fitted model nor the tokenizer; tests/llm holds the stages, toxicity aside, against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, write_and_read(stage(spark, docs, sf_dir), f"stage-{name}")
        if name != STAGES[0][0]:
            drop_stored(before)
    return STAGES[-1][1](spark, docs, sf_dir)
