import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_fixtures import AWKWARD, documents
from tickerloom.llm import wavelet

PATH = public_tokenizers.path("byte_bpe_50k.json")


def opened(doc_ids, counts, ids):
    data = b"".join(wavelet.pack_shard(doc_ids, counts, ids))
    return wavelet.Shard(pa.BufferReader(data))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 50_256), min_size=1, max_size=300), st.booleans())
def test_access_rank_and_select_agree_with_the_ids(values, narrow):
    ids = np.array(values, "<u2") % (7 if narrow else 60_000)
    shard = opened([4, None], [1, len(ids) - 1], ids)
    assert shard.decode().tolist() == ids.tolist()
    assert shard.doc_ids == [4, None] and shard.counts.tolist() == [1, len(ids) - 1]
    assert [shard.access(i) for i in range(len(ids))] == ids.tolist()
    for token in {*ids.tolist(), 3, 70_000}:
        places = np.flatnonzero(ids == token).tolist()
        assert shard.count(token) == len(places) and shard.occurrences(token) == places
        low, high = len(ids) // 3, 2 * len(ids) // 3
        assert shard.count(token, low, high) == sum(low <= p < high for p in places)
    with pytest.raises(IndexError):
        shard.access(len(ids))
    with pytest.raises(IndexError):
        shard.select(int(ids[0]), len(ids))


def test_blocks_are_joined():
    ids = np.random.default_rng(1).integers(0, 900, 3 * wavelet.BLOCK_BITS + 17).astype("<u2")
    shard = opened([1], [len(ids)], ids)
    assert (shard.decode() == ids).all()
    for at in (0, wavelet.BLOCK_BITS - 1, wavelet.BLOCK_BITS, len(ids) - 1):
        assert shard.access(at) == ids[at]
    token = int(ids[100_000])
    places = np.flatnonzero(ids == token)
    assert [shard.select(token, k) for k in (0, len(places) - 1)] == places[[0, -1]].tolist()
    assert shard.count(token, 5, 150_000) == ((places >= 5) & (places < 150_000)).sum()


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    found, start = [], 0
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        found.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


@pytest.mark.parametrize("shard_tokens", [5, 1 << 20])
def test_documents_come_back_from_the_files(spark, shard_tokens):
    docs = documents(spark, AWKWARD).repartition(3)
    manifest = wavelet.write_shards(docs, PATH, 0, shard_tokens)
    order = lambda rows: sorted(rows, key=lambda r: r[1])
    digest = order(map(tuple, wavelet.digest_documents(manifest).collect()))
    assert digest == expected(AWKWARD)
    read = order(map(tuple, wavelet.read_documents(manifest).collect()))
    raw = [np.frombuffer(bytes(r[3]), "<u2").astype("<u4") for r in read]
    assert [(*r[:3], zlib.crc32(ids)) for r, ids in zip(read, raw)] == digest
    stream = np.concatenate(raw)
    token = int(stream[0])
    found = sorted(r[0] for r in wavelet.token_occurrences(manifest, token).collect())
    assert found == np.flatnonzero(stream == token).tolist()


def test_an_empty_table_has_no_shards(spark):
    manifest = wavelet.write_shards(documents(spark, []), PATH)
    assert manifest.count() == 0 and wavelet.digest_documents(manifest).count() == 0
