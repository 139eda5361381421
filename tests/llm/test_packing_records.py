"""Packing and record files against the tokenizer itself."""

import os
from collections import defaultdict

import numpy as np
import pytest

from strata.llm import common, packing, records
from strata.llm.common import crc_u32
from strata.llm.tokens import Encoder, tokenizer_path

SCHEMA = "doc_id long, text string, doc string, ids string, tier int"
ROWS = [(i, " ".join(f"w{i}x{j}" for j in range(n)), "a", "b", 0) for i, n in
        enumerate((0, 1, 3, 700, 40, 41, 42, 90, 200, 5, 5, 5, 1500, 12))] + [
    (50, None, "a", "b", 0), (51, "", None, None, None), (None, "no id", "a", "b", 1), (52, "same", "x", "y", 1),
    (52, "same", "x", "y", 1)]


@pytest.fixture(scope="module")
def enc():
    return Encoder(tokenizer_path())


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def test_every_id_in_one_piece(spark, docs, enc):
    got = packing.pack(spark, docs, step_tokens=2048, with_ids=True).collect()
    seqs, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append(r)
        pieces[r.doc].append((r.start, bytes(r.ids)))
        assert r.length == len(r.ids) // 4 and r.ids_crc32 == crc_u32(np.frombuffer(r.ids, "<u4"))
    want = defaultdict(list)
    for i, text, *_ in ROWS:
        want[i].append(np.append(enc.encode(text), 0).astype("<u4").tobytes())
    for i, texts in want.items():
        assert sorted(b"".join(x for _, x in sorted(pieces[i]))) == sorted(b"".join(texts))
        if len(texts) == 1:
            at = 0
            for start, ids in sorted(pieces[i]):
                assert start == at
                at += len(ids) // 4
            assert b"".join(x for _, x in sorted(pieces[i])) == texts[0]
    padded = 0
    for rows in seqs.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        padded += at != rows[0].tier
        assert at <= rows[0].tier <= 1024 and (at == rows[0].tier or at < 64)
    assert padded <= 3                      # one rest per task
    assert sorted(seqs) == list(range(len(seqs)))
    load = defaultdict(lambda: defaultdict(int))
    for rows in seqs.values():
        load[rows[0].tier][rows[0].step_group] += 1
    for per_group in load.values():
        assert max(per_group.values()) - min(per_group.values()) <= 1


def test_packer_prefers_whole_short_documents():
    p = packing.Packer()
    for i, n in enumerate((1000, 24, 500, 12, 200, 56)):
        p.add(i, np.zeros(n, "<u2"))
    p.pack(last=True)
    done = p.take()
    assert sorted((t, sorted(len(x[2]) for x in w)) for t, w in done) == [
        (256, [56, 200]), (512, [12, 500]), (1024, [24, 1000])]


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert packing.pack(spark, none).collect() == []
    manifest, root = records.write_records(spark, none)
    assert manifest.count() == 0 and records.read_records(spark, manifest, root).collect() == []


def test_records_round_trip_in_order(spark, docs, enc, monkeypatch):
    monkeypatch.setattr(records, "small_batches", lambda s: common.small_batches(s, 4))     # several shards
    manifest, root = records.write_records(spark, docs, end_id=2, shard_bytes=2000)
    assert manifest.count() > 1
    back = sorted(records.read_records(spark, manifest, root).collect(), key=lambda r: r.start)
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.key for r in back] == [None if r[0] is None else str(r[0]) for r in order]
    at = 0
    for r, (_, text, *_) in zip(back, order):
        ids = np.append(enc.encode(text), 2).astype("<u4")
        assert (r.start, r.n_tokens, bytes(r.ids), r.ids_crc32) == (at, len(ids), ids.tobytes(), crc_u32(ids))
        at += len(ids)
    for seed in (1, 2):
        mixed = records.read_shuffled(spark, manifest, root, seed).orderBy("order").collect()
        assert sorted((str(r.key), bytes(r.ids)) for r in mixed) == sorted((str(r.key), bytes(r.ids)) for r in back)
        assert [r.key for r in mixed] != [r.key for r in back]


def test_crc32c_known_values_and_damage():
    assert records.crc32c([b"123456789", b"\0" * 32, b"\xff" * 32]).tolist() == [0xE3069283, 0x8A9136AA, 0x62A8AB43]
    payloads = [records.payload(k, np.arange(n, dtype="<u2")) for k, n in (("a", 3), (None, 0), ("", 900), ("é", 1))]
    raw, lengths = records.frames(payloads)
    assert records.unframe(raw)[0] == payloads and int(lengths.sum()) == len(raw)
    assert [records.parse(p)[0] for p in payloads] == ["a", None, "", "é"]
    for at in (0, 9, 14, len(raw) - 1):
        bad = bytearray(raw)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            records.unframe(bytes(bad))
    with pytest.raises(ValueError):
        records.unframe(raw[:-1])


def test_only_manifest_files_are_read(spark, docs):
    manifest, root = records.write_records(spark, docs)
    before = records.read_records(spark, manifest, root).count()
    path = root.replace("file:", "", 1)
    with open(os.path.join(path, "shard-00000-0000-deadbeef.rec"), "wb") as f:      # of an attempt that died
        f.write(b"half a record")
    assert records.read_records(spark, manifest, root).count() == before
