import glob
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import token_files as TF
from tidemark.llm.encoders import ByteEncoder
from tidemark.session import scratch_path

from .conftest import awkward_texts, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def wanted(rows, library):
    """(doc_id, start, n_tokens, crc) of rows in their order, and all ids."""
    out, ids = [], []
    for i, t in rows:
        own = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((i, len(ids), len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        ids += own
    return out, ids


def test_encoder_is_the_library_on_every_code_point(library):
    fast = ByteEncoder(PATH, False)
    points = [c for c in range(0x110000) if unicodedata.category(chr(c)) not in ("Cn", "Co", "Cs")]
    for at in range(0, len(points), 4096):
        texts = [f"a{chr(c)}1 {chr(c)} {chr(c)}{chr(c)}  b '{chr(c)}  {chr(c)}"
                 for c in points[at:at + 4096]]
        want = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
        assert [fast.encode(t).tolist() for t in texts] == want


def test_encoder_on_awkward_texts(library):
    fast, plain = ByteEncoder(PATH, False), ByteEncoder(PATH, True)
    spelled = Tokenizer.from_file(PATH)
    spelled.encode_special_tokens = True
    texts = [t or "" for t in awkward_texts()] + [
        " " * 1_000_000, "\n" * 50_000, "<|endoftext|>", "a  <|endoftext|>  <|endoftext|><|endo"]
    for t in texts:
        assert fast.encode(t).tolist() == library.encode(t, add_special_tokens=False).ids
        assert plain.encode(t).tolist() == spelled.encode(t, add_special_tokens=False).ids


def test_rows_against_the_library(spark, library):
    rows = [(k, t) for k, t in enumerate(awkward_texts())]
    df = spark.createDataFrame(rows[::-1], "doc_id long, text string").withColumn("ids", F.lit(1))
    got = TF.round_trip(df.repartition(3), PATH).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == wanted(rows, library)[0]


def test_repeated_and_null_ids(docs, empty, library):
    """Null ids come first; rows of one id are all there, each starting where another
    row ends."""
    got = sorted((tuple(r) for r in TF.round_trip(docs, PATH).collect()), key=lambda r: r[1])
    assert got[0][0] is None and [r[0] for r in got[1:]] == sorted(r[0] for r in got[1:])
    assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:]))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    key = lambda r: str((r[0], *r[2:]))
    assert sorted(map(key, got)) == sorted(map(key, wanted(rows, library)[0]))
    assert TF.round_trip(empty, PATH).count() == 0


@pytest.fixture(scope="module")
def stored(spark, library):
    rows = [(3 * k, prose(k, 20 + 37 * k % 400)) for k in range(400)]
    out = scratch_path(spark, "tokens")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    TF.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), PATH, out)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    return out, *wanted(rows, library)


def test_files(stored):
    out, rows, _ = stored
    files = sorted(glob.glob(out.removeprefix("file:") + "/tokens/*.parquet"))
    assert len(files) > 1
    met = 0
    for f in files:
        meta = pq.ParquetFile(f).metadata
        met += meta.num_rows
        group = meta.row_group(0)
        columns = {group.column(i).path_in_schema: group.column(i) for i in range(5)}
        assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings
        for c in ("doc_id", "at", "n_tokens"):
            assert "DELTA_BINARY_PACKED" in columns[c].encodings
        assert all(c.has_column_index and c.has_offset_index for c in columns.values())
    assert met == len(rows)


def test_documents_and_places(spark, stored):
    out, rows, ids = stored
    some = TF.read_documents(spark, out, first=300, last=330)
    assert "GreaterThanOrEqual(doc_id,300)" in some._jdf.queryExecution().toString()
    want = [(i, s, n, ids[s:s + n]) for i, s, n, _ in rows if 300 <= i <= 330]
    assert [tuple(r) for r in some.orderBy("doc_id").collect()] == want
    places = TF.read_places(spark, out)
    scans = places._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in scans.split("ReadSchema", 1)[1].split("\n")[0]
    assert sorted((r["doc_id"], r["start"], r["n_tokens"]) for r in places.collect()) == [
        r[:3] for r in rows]


def test_window(spark, stored):
    out, rows, ids = stored
    for start, length in ((0, 1), (5, 700), (len(ids) // 2 - 3000, 6000), (len(ids) - 3, 50),
                          (len(ids), 9), (7, 0), (0, len(ids))):
        parts = sorted(TF.read_window(spark, out, start, length).collect(), key=lambda r: r["start"])
        assert [i for p in parts for i in p["ids"]] == ids[start:start + length]
        assert not parts or parts[0]["start"] == start
