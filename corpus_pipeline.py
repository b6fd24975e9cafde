"""From documents to token ids: toxic documents go, one of each group of near duplicates stays,
passages that an earlier document has go, sources are mixed to their weights, texts are encoded.

Each stage works on all that its predecessor kept and returns the columns of documents; the last
returns the encoded texts. With null, empty or repeated rows, empty tables and further columns the
stages do what the operators that they call say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkforge.llm.bpe import round_trip
from linkforge.llm.common import Scratch, table
from linkforge.llm.mixing import mixed
from linkforge.llm.ngram_join import one_of_each
from linkforge.llm.queries import default_tokenizer
from linkforge.llm.substring_dedup import without_passages
from linkforge.llm.toxicity import clean_documents


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not rejected, as they are. Null and empty texts are scored like others; rows
    that repeat a doc_id are judged by their own texts."""
    return clean_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 of five-word shingles: that of
    the smallest doc_id. Texts without words and rows without doc_id stay; of equal rows one stays."""
    return one_of_each(docs, k=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 50 words or more that one of a smaller doc_id has; rows
    without doc_id stay as they are."""
    return without_passages(docs, window=50)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, whole: sources weigh 3, 1, 2 in turn and share 1.5
    times all words. A null source is a source; documents without words go where their key puts them."""
    return mixed(docs, table(spark, sf_dir, "labels"), weights=(3, 1, 2), share=1.5, most=2.0)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids of every text, their number, and digests of ids and decoded text; null and
    empty texts have no ids."""
    return round_trip(docs, default_tokenizer(), ids=True)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("substring_dedup", substring_dedup), ("mixing", mixing), ("bpe", bpe)]

#: SQL can express neither the classifier nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the table of a stage goes once the next one is written."""
    docs, before = table(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES[:-1]:
        after = Scratch(spark)
        docs = after(stage(spark, docs, sf_dir), name)
        before.drop()
        before = after
    return STAGES[-1][1](spark, docs, sf_dir)
