import json
import os
import random
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from quill.operators import pack
from quill.sources import corpus_stream
from quill.streaming.stream import pack_stream, stateful, stream_corpus


def _run(spark, base, stream, B, T):
    with stateful(spark, 2):
        q = (pack_stream(stream, B, T).writeStream.format("parquet").option("path", os.path.join(base, "out"))
             .option("checkpointLocation", os.path.join(base, "ckpt")).trigger(availableNow=True).start())
        q.awaitTermination(300)
    return sorted((r.rank, r.block, r.row, list(r.inputs), list(r.targets)) for r in spark.read.parquet(os.path.join(base, "out")).collect())


def test_pack_stream_in_any_order_and_over_a_restart(spark):
    """Documents arrive in any order, some twice, and the query is stopped half-way."""
    base = tempfile.mkdtemp(prefix="quill-stream-", dir="/tmp")
    src = os.path.join(base, "src")
    rng = random.Random(5)
    docs = {rank: [[0] + list(range(1, 1 + rng.randint(0, 40))) for _ in range(30)] for rank in (0, 1)}
    docs[0][7] = list(range(200))       # longer than several blocks
    rows = [(rank, i, ids) for rank in docs for i, ids in enumerate(docs[rank])]
    rng.shuffle(rows)
    rows.insert(40, rows[3])
    schema = "rank int, seq bigint, ids array<int>"

    def put(part):
        for at in range(0, len(part), 8):
            spark.createDataFrame(part[at:at + 8], schema).coalesce(1).write.mode("append").parquet(src)
    put(rows[:30])

    def source():
        return stream_corpus(spark, src, spark.read.parquet(src).schema, files_per_batch=2, columns=("rank", "seq", "ids"))
    early = _run(spark, base, source(), 2, 8)
    put(rows[30:])
    got = _run(spark, base, source(), 2, 8)
    want = []
    for rank, each in docs.items():
        bdf = spark.createDataFrame(list(enumerate(each)), "doc_id bigint, ids array<int>")
        want += [(rank, r.block, r.row, list(r.inputs), list(r.targets)) for r in pack.pack(bdf, 2, 8).collect()]
    assert got == sorted(want) and len(early) < len(got)


@pytest.fixture()
def corpus(tmp_path):
    folder = tmp_path / "corpus"
    folder.mkdir()
    n = 0
    for k, rows in enumerate((10, 3, 0, 9)):
        t = pa.table({"doc": pa.array(range(n, n + rows), pa.int64()), "text": [f"t{i}" for i in range(n, n + rows)]})
        pq.write_table(t, folder / f"shard_{k:05d}.parquet", row_group_size=4)
        n += rows
    (folder / "shard_00009.parquet.tmp").write_bytes(b"unfinished")
    return str(folder), str(tmp_path / "progress")


def _expected(epochs, ranks):
    seq, out = [0] * ranks, []
    for e in range(epochs):
        n = 0
        for k, rows in enumerate((10, 3, 0, 9)):
            for i in range(rows):
                rank = i // 4 % ranks
                out.append((e, f"shard_{k:05d}.parquet", i // 4, i % 4, rank, seq[rank], n + i))
                seq[rank] += 1
            n += rows
    return sorted(out)


def test_epochs_and_restart(spark, corpus, tmp_path):
    path, progress = corpus
    for epochs in (1, 3):
        s = corpus_stream.stream_epochs(spark, path, progress, "doc bigint", ranks=2, groups=2, epochs=epochs)
        q = s.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ckpt")).start()
        q.processAllAvailable()
        q.stop()
        got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("epoch", "shard", "row_group", "row", "rank", "seq", "doc").collect())
        assert got == _expected(epochs, 2)


def _reader(path, progress, **kw):
    from pyspark.sql.types import _parse_datatype_string  # noqa: PLC0415
    options = {"path": path, "progress": progress, "columns": "doc bigint", **{k: str(v) for k, v in kw.items()}}
    source = corpus_stream.CorpusSource(options)
    return source.streamReader(_parse_datatype_string(source.schema()))


def test_offsets_continue_endlessly(spark, corpus):
    path, progress = corpus
    r = _reader(path, progress, groups=5)
    start, docs = r.initialOffset(), []
    for _ in range(6):          # six row groups hold an epoch of 22 rows; no end is given
        end = r.latestOffset()
        for p in r.partitions(start, end):
            docs += [x for b in r.read(p) for x in b.column("doc").to_pylist()]
        start = end
    assert docs[:66] == [*range(22)] * 3 and end["epoch"] >= 3
    again = _reader(path, progress, groups=5)       # a new process goes on where the last one was
    assert again.partitions(end, again.latestOffset())[0].seq == end["seq"][0]
    with open(os.path.join(progress, "position.json")) as f:
        assert json.load(f)["epoch"] >= end["epoch"]
    with pytest.raises(ValueError, match="does not lead"):
        _reader(path, progress, epochs=9).partitions({**end, "epoch": 8}, {**end, "epoch": 0})


def test_empty_corpus(spark, tmp_path):
    (tmp_path / "none").mkdir()
    r = _reader(str(tmp_path / "none"), str(tmp_path / "p"))
    assert r.latestOffset() == r.initialOffset() and r.partitions(r.initialOffset(), r.latestOffset()) == []


def test_a_backlog_is_read_in_growing_batches(spark, tmp_path):
    (tmp_path / "corpus").mkdir()
    for k in range(100):
        pq.write_table(pa.table({"doc": pa.array(range(k * 8, k * 8 + 8), pa.int64())}), tmp_path / "corpus" / f"shard_{k:05d}.parquet", row_group_size=1)

    def batches(**kw):
        r = _reader(str(tmp_path / "corpus"), str(tmp_path / f"progress{len(kw)}{kw.get('most', 0)}"), groups=5, epochs=1, tasks=4, **kw)
        start, out = r.initialOffset(), []
        while (end := r.latestOffset()) != start:
            parts = r.partitions(start, end)
            assert len(parts) <= 4
            out.append([x for p in parts for b in r.read(p) for x in b.column("doc").to_pylist()])
            start = end
        assert sum(out, []) == list(range(800))
        return [len(b) for b in out]
    assert batches(grow=2) == [5, 10, 20, 40, 80, 160, 320, 165]
    assert batches(grow=2, most=100) == [5, 10, 20, 40, 80] + [100] * 6 + [45]
    assert batches() == [5] * 160


def test_shuffle_stream_reads_a_backlog_in_few_batches(spark, monkeypatch):
    from quill import catalog
    seen, count = [], catalog._batches
    monkeypatch.setattr(catalog, "_batches", lambda *a: seen.append(count(*a)) or seen[-1])
    n = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()
    rows = catalog.QUERIES["shuffle_stream"](spark, "/root/testdata/sf0.01")
    groups = -(-n // 64)
    assert groups > 12 and seen[0] <= (groups // 6).bit_length()     # 6 + 12 + 24 + …; before, one for every 6
    assert rows.select("doc_id", "pos").distinct().count() == rows.count()


class _Map(dict):
    calls = 0

    def containsKey(self, k):
        return k in self

    def getValue(self, k):
        return self[k]

    def updateValue(self, k, v):
        self.calls += 1
        self[k] = v

    def removeKey(self, k):
        del self[k]


class _One(list):
    def exists(self):
        return bool(self)

    def get(self):
        return self[0]

    def update(self, v):
        self[:] = [v]

    put = update

    def clear(self):
        self[:] = []


class _Handle:
    def __init__(self):
        self.maps = {}

    def getValueState(self, *_):
        return _One()

    getListState = getValueState

    def getMapState(self, name, *_):
        return self.maps.setdefault(name, _Map())


def test_early_documents_wait_in_pages():
    """A thousand early documents, some twice and in several chunks, take a few writes to the state."""
    import pandas as pd
    from quill.streaming.stream import _Packer
    packer, handle, rng = _Packer(1, 10), _Handle(), random.Random(3)
    packer.init(handle)
    docs = [list(range(i, i + rng.randint(0, 9))) for i in range(1000)]

    def come(*chunks):
        frames = (pd.DataFrame({"seq": list(c), "ids": [docs[i] for i in c]}) for c in chunks)
        return [int(t) for f in packer.handleInputRows((0,), frames, None) for x in f["tokens"] for t in x]
    late = list(range(300, 700))
    rng.shuffle(late)
    assert come(range(700, 1000), late, range(650, 720)) == []
    assert sum(m.calls for m in handle.maps.values()) < 60
    flat = [t for d in docs for t in d]
    got = come(range(1, 300)) + come([0, 5]) + come([999])
    assert got == flat[:len(flat) // 11 * 11] and not any(handle.maps.values())


def test_pack_stream_leaves_its_blocks_only(spark, monkeypatch):
    """What numbered the documents, the source that was passed through, the state and the shuffle files go."""
    from quill import catalog, session
    made, folder = [], session.shared_folder
    bases, base = [], catalog._folder
    monkeypatch.setattr(session, "shared_folder", lambda *a: made.append(folder(*a)) or made[-1])
    monkeypatch.setattr(catalog, "_folder", lambda *a: bases.append(base(*a)) or bases[-1])
    rows = catalog.QUERIES["pack_stream"](spark, "/root/testdata/sf0.001")
    assert rows.count() and made and not any(os.path.exists(p.removeprefix("file:")) for p in made)
    assert os.listdir(bases[0].removeprefix("file:")) == ["out"]
    assert spark.conf.get(session.SHUFFLES_GO, None) is None


def test_early_documents_are_kept_small():
    from quill.streaming import stream
    rng = random.Random(3)
    ids = np.array([rng.choice(b"etaoin shrdlu") for _ in range(4000)], np.int32)
    assert len(stream._packed(ids)) < len(ids)          # four bytes an id before
    for x in (ids, ids[:0], np.array([-1, 2**31 - 1, 70_000, 0], np.int32)):
        assert (stream._unpacked(stream._packed(x), len(x)) == x).all()
