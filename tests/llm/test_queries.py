"""Queries whose columns SQL cannot give, against the libraries themselves."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from tokenizers import Tokenizer

from lanewise.llm.queries import QUERIES


def read(sf_dir):
    table = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return {r["doc_id"]: r["text"] or "" for r in table}


@pytest.fixture(scope="module")
def texts(sf_dir):
    return read(sf_dir)


def test_byte_bpe(spark, sf_dir, texts):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = QUERIES["op2_byte_bpe"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_packing(spark, sf_dir, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.encode_special_tokens = True
    rows = QUERIES["op7_packing"](spark, sf_dir).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert sorted(by_doc) == sorted(texts)
    for doc, pieces in by_doc.items():
        ids = np.array(library.encode(texts[doc], add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            part = ids[r["start"] : r["start"] + r["length"]]
            assert (r["start"], r["doc_tokens"]) == (at, len(ids)) and len(part) == r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
            at += r["length"]
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == 4096 or at & (at - 1) == 0 and at < 4096


KINDS = {
    "assign": (re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 16),
    "hex": (re.compile(r"[0-9a-f]+"), 32),
}


def test_secret_scans(spark, sf_dir):
    sf_dir = sf_dir.replace("0.001", "0.01")  # the smaller table holds none
    texts = read(sf_dir)
    rows = QUERIES["op4_secret_scans"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    found = 0
    for r in rows:
        base = []
        for order, (kind, (pattern, least)) in enumerate(KINDS.items()):
            held = [m for m in pattern.finditer(texts[r["doc_id"]]) if len(m.group(m.lastindex or 0)) >= least]
            assert r[f"n_{kind}"] == len(held)
            base += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in held]
        listed = [s for *_, s in sorted(base)]
        found += len(listed)
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r["spans"].split(","))
    assert found
