"""What a stage's Python worker holds beside the batch that Spark hands it."""

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shelfcast.llm import packing, secrets, toxicity
from shelfcast.llm.packing import pieces
from shelfcast.llm.secrets import redact
from shelfcast.llm.toxicity import Lexicon, reject_toxic

ROWS = 6000
JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


class Worker:
    """Stands for a DataFrame: keeps the function that the workers would run."""

    schema, dtypes = StructType([StructField("doc_id", LongType()), StructField("text", StringType())]), [("doc_id", "bigint"), ("text", "string")]

    def __init__(self):
        self.sparkSession = self.sparkContext = self

    def broadcast(self, value):
        self.value = value
        return self

    def select(self, *columns):
        return self

    def mapInArrow(self, function, schema):
        self.run = function
        return self


@pytest.mark.parametrize("stage", ["toxicity", "secrets", "packing"])
def test_workers_hold_a_part_of_a_batch(spark, monkeypatch, stage):
    for module in (packing, secrets, toxicity):
        monkeypatch.setattr(module, "ship_package", lambda spark: None)
    monkeypatch.setattr(toxicity, "lexicon_of", lambda *a: Lexicon({"^slur$": 2.0}, set()))
    worker = Worker()
    {"toxicity": lambda: reject_toxic(worker, None), "secrets": lambda: redact(worker), "packing": lambda: pieces(worker, 1024, 0, JSON, RANKS)}[stage]()

    texts = [f"{i} token = abcdefgh{i:08d} " + "plain words of a text " * 20 for i in range(ROWS)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(ROWS), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    before, most, ids = pa.total_allocated_bytes(), 0, []
    for out in worker.run(iter([batch])):
        most = max(most, pa.total_allocated_bytes() - before)
        ids += out.column(0).to_pylist()
    assert ids == list(range(ROWS))  # short texts: one row each, in order
    assert 4 * most < batch.nbytes


def test_plan_tables_need_no_python_workers(spark):
    names = ["length", "parts"]
    for rows in ([(1024, 3), (7, 1)], []):
        table = packing._table(spark, rows, names)
        assert table.dtypes == [(n, "bigint") for n in names] and list(map(tuple, table.collect())) == rows
