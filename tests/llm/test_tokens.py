"""Coded token files against the tokenizer itself."""

from __future__ import annotations

import hashlib
import os
import subprocess
import sys
import zlib
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from samples import prose
from tokenizers import Tokenizer

from fairdraw.llm import rans, text, tokens
from fairdraw.llm.storage import new_folder

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(rows):
    tokenizer, out, start = Tokenizer.from_file(PATH), [], 0
    coded = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows]
    coded.sort(key=lambda r: (r[0] is not None, r[0] or 0, np.array(r[1], "<u2").tobytes()))
    for i, ids in coded:
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


AWKWARD = [
    "", None, " \t\n", "don't they'll 's 'tis it's", "abc,def. (ghi)! 3,141.59 x2y", "Ünïcödé ÉÈÇ straße ſ ŉ İstanbul ǅ",
    "é äo café, ́lead", "中文 テキスト, 😀😀 ok", "a b c\u0085d\x1ce", "<|endoftext|> <|startoftext|>",
    "x" * 5000, "ab " * 4000, "É" * 300, "no\x00nul", "αΣ ΣΑΣ ὈΔΥΣΣΕΎΣ", "it's’ l’été «dé» —dash", "'''", "a'b'c 'll 're",
]


def test_ids_are_those_of_the_tokenizer(spark, documents):
    rows = [*enumerate(AWKWARD), *((100 + i, prose(i, 40 + i)) for i in range(60))]
    rows += [(None, "no id"), (None, None), (3, "again"), (3, "again"), (5, AWKWARD[5])]
    got = tokens.encode_documents(documents(rows), PATH)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == expected(rows)


def test_empty_table(documents):
    assert tokens.encode_documents(documents([]), PATH).collect() == []


def test_long_document_goes_through_several_blocks(spark, documents):
    rows = [(0, prose(1, 30)), (1, prose(2, 5000)), (2, ""), (3, prose(3, 450)), (4, prose(4, 2000))]
    folder = new_folder(spark, "tokens")
    tokens.write_tokens(documents(rows), PATH, 2, folder, 1, block=500)
    files = tokens.open_tokens(spark, folder)
    units = files.manifest.orderBy("file_no", "unit_no").collect()
    assert max(u.blocks for u in units) > 3
    back = tokens.read_ids(files).orderBy("doc_id", "part").collect()
    tokenizer = Tokenizer.from_file(PATH)
    for i, text in rows:
        ids = [x for r in back if r.doc_id == i for x in r.ids]
        assert ids == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 1000, 70_000, 200_001])
def test_coder_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 49_000).astype(np.uint32)
    model = rans.Model.of_counts(np.bincount(ids, minlength=49_408))
    block = rans.encode(ids, model)
    assert (rans.decode(block, model) == ids).all()
    if n >= 1000:
        # Within two per cent and the states of the entropy.
        p = np.bincount(ids) / n
        p = p[p > 0]
        assert len(block) <= 1.02 * -(p * np.log2(p)).sum() * n / 8 + 8 * rans.LANES + 100


def test_every_id_once():
    model = rans.Model.of_counts(np.r_[10**9, np.ones(49_407, np.int64)])
    assert model.frequency.sum() == 1 << rans.SCALE and model.frequency.min() == 1
    ids = np.arange(49_408, dtype=np.uint32)
    assert (rans.decode(rans.encode(ids, model), model) == ids).all()


def test_damage_is_noticed():
    ids = np.arange(2000, dtype=np.uint32) % 7
    model = rans.Model.of_counts(np.bincount(ids))
    block = bytearray(rans.encode(ids, model))
    block[40] ^= 1
    try:
        assert (rans.decode(bytes(block), model) != ids).any()
    except (ValueError, IndexError):
        pass


def test_words_of_regular_patterns_keep_their_ids(documents):
    rows = []
    for n in (512, 1024, 4096):
        one = "".join("ab"[i.bit_count() % 2] for i in range(n))
        rows += [(len(rows), one), (len(rows) + 1, one.translate(str.maketrans("ab", "ba")))]
    got = tokens.encode_documents(documents(rows).coalesce(1), PATH)
    assert sorted(map(tuple, got.collect())) == expected(rows)


ALONE = """
import sys
sys.path.insert(0, sys.argv[1])
from tools.session import local_session
from fairdraw.llm import tokens

spark = local_session("alone", cpus="2")
spark.sparkContext.environment["PYTHONPATH"] = sys.argv[1]
files = tokens.open_tokens(spark, sys.argv[2])
print("TOKENS", files.end_id, files.tokenizer_sha256, sorted((r.doc_id, r.ids) for r in tokens.read_ids(files).collect()))
"""


def test_a_folder_alone_is_read_in_another_session(spark, documents, tmp_path):
    rows = [(i, prose(i, 30 + i)) for i in range(12)]
    folder = f"{tmp_path}/alone"
    tokens.write_tokens(documents(rows), PATH, 2, folder)
    assert sorted(x for x in os.listdir(folder) if not x.startswith(".")) == ["files", "manifest", "model"]
    root = str(Path(__file__).resolve().parents[2])
    said = subprocess.run([sys.executable, "-c", ALONE, root, f"file:{folder}"], capture_output=True, text=True, timeout=300, check=True)
    line = next(x for x in said.stdout.splitlines() if x.startswith("TOKENS"))
    tokenizer = Tokenizer.from_file(PATH)
    ids = [(i, [*tokenizer.encode(t, add_special_tokens=False).ids, 2]) for i, t in rows]
    assert line == f"TOKENS 2 {hashlib.sha256(Path(PATH).read_bytes()).hexdigest()} {ids}"


def test_many_documents_without_id_are_spread(spark, documents):
    rows = [(None, prose(i, 20)) for i in range(400)]
    tokens.write_tokens(documents(rows), PATH, 2, folder := new_folder(spark, "tokens"), 8)
    files = tokens.open_tokens(spark, folder)
    sizes = [r["n"] for r in files.manifest.groupBy("file_no").agg(F.sum("docs").alias("n")).collect()]
    assert sum(sizes) == 400 and max(sizes) < 200


def test_encoding_starts_no_threads():
    """Workers of one core each would hold memory for a thread per core."""
    code = f"""
import os
import pyarrow as pa
from fairdraw.llm import text, tokens
encoder = tokens.Encoder(open({PATH!r}, encoding="utf-8").read(), tokens.id_type(49152))
before = len(os.listdir("/proc/self/task"))
encoder(text.texts_of(pa.array([" ".join(f"{{i}}-é中{{i}}" for i in range(2000))])))
print(len(os.listdir("/proc/self/task")) - before)
"""
    env = {k: v for k, v in os.environ.items() if k not in ("TOKENIZERS_PARALLELISM", "RAYON_NUM_THREADS")}
    env["PYTHONPATH"] = str(Path(tokens.__file__).parents[2])
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == ["0"], done.stderr


def test_the_driver_loads_no_tokenizer(monkeypatch):
    monkeypatch.setattr(Tokenizer, "from_file", None)
    assert tokens.vocabulary_size(PATH, 2) == 49_408 and tokens.vocabulary_size(PATH, 60_000) == 60_001


@pytest.mark.parametrize("hashes", ["own", "equal"])
def test_new_words_reach_the_model_together(monkeypatch, hashes):
    """Words of Latin letters, those at the borders of that range, and others."""
    monkeypatch.setattr(tokens, "REMEMBERED", 300)
    if hashes == "equal":
        monkeypatch.setattr(text, "_hashes", lambda data, start, end: np.zeros(len(start), np.uint64))
    odd = ["İx", "a×b", "a÷b", "ǅungla", "ŉa", "Ⱥb", "ǿǾ", "ÀÿƀǿȀɏ", "ªº", "µ", "e\u0301", "É" * 19, "É" * 20, "É" * 21, "z" * 41, "x2y", "don't"]
    whole, encoder = Tokenizer.from_file(PATH), tokens.Encoder(Path(PATH).read_text(encoding="utf-8"), tokens.id_type(49_408))
    calls, model = [], encoder.words
    encoder.words = SimpleNamespace(encode_batch_fast=lambda words, **other: calls.append(words) or model.encode_batch_fast(words, **other))
    for i in range(6):
        some = [prose(i, 200), " ".join(f"w{chr(97 + j % 26)}{chr(97 + j // 26)}{'qrstuv'[i]}Ä" for j in range(500)), "", " ".join(odd), *odd]
        ids, first = encoder(text.texts_of(pa.array(some)))
        assert [ids[first[j] : first[j + 1]].tolist() for j in range(len(some))] == [x.ids for x in whole.encode_batch(some, add_special_tokens=False)]
    assert len(calls) == 6 and len(encoder.known.hashes) <= 600


def test_counts_of_ids(spark):
    rows = [(bytes([1, 0, 5, 0, 1, 0]),), (b"",), (bytes([255, 191]),)]
    counts = tokens.counts_of(spark.createDataFrame(rows, "ids binary").repartition(2), 49_408)
    assert counts[[1, 5, 49_151]].tolist() == [2, 1, 1] and counts.sum() == 4
    assert tokens.counts_of(spark.createDataFrame([], "ids binary"), 49_408).sum() == 0
