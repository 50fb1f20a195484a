import glob
import io
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pricerisk.llm.records import DamagedRecord, frame, read_frame, read_record, read_records, records_round_trip, write_records
from tests.llm.helpers import ODD_TEXTS, clashing, documents

PATH = public_tokenizers.path("word_bpe_49k.json")


def want(rows):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    out, start = [], 0
    for i, text in rows:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_round_trip(spark):
    got = [tuple(r) for r in records_round_trip(clashing(documents(spark, ODD_TEXTS)), PATH).collect()]
    rows = sorted(ODD_TEXTS, key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted(got, key=lambda r: r[1]) == want(rows)


def test_files_roll_and_index_points_at_records(spark, tmp_dir):
    rows = [(i, f"text number {i} " * 20) for i in range(60)]
    index = write_records(documents(spark, rows), PATH, tmp_dir, n_parts=3, file_bytes=1000).collect()
    assert len({r.file for r in index}) > 6
    expected = {i: (n, crc) for i, _, n, crc in want(rows)}
    for r in index[::7]:
        doc, ids = read_record(spark, tmp_dir, r.file, r.byte_offset)
        assert doc == r.doc_id and (len(ids), zlib.crc32(ids.tobytes())) == expected[doc]
    back = {r.doc_id: r for r in read_records(spark, tmp_dir).collect()}
    assert all(zlib.crc32(back[i].ids) == back[i].ids_crc32 for i in back)
    assert [back[i].start for i in range(60)] == [s for _, s, _, _ in want(rows)]
    # a file that no index row names, as a lost attempt leaves it, is not read
    with open(f"{tmp_dir}/data/part-000000-0000-lost.rec", "wb") as f:
        f.write(b"\x00" * 40)
    assert read_records(spark, tmp_dir).count() == 60


def test_damage_is_found(spark, tmp_dir):
    data = frame(5, np.arange(9, dtype="<u2").tobytes(), 2)
    assert read_frame(io.BytesIO(data))[1].tolist() == list(range(9))
    for k in (2, 9, 20, len(data) - 1):
        broken = bytearray(data)
        broken[k] ^= 1
        with pytest.raises(DamagedRecord):
            read_frame(io.BytesIO(bytes(broken)))
    write_records(documents(spark, [(1, "a b"), (2, "c")]), PATH, tmp_dir, n_parts=1)
    (path,) = glob.glob(f"{tmp_dir}/data/*.rec")
    size = os.path.getsize(path)
    with open(path, "r+b") as f:
        f.truncate(size - 3)
    with pytest.raises(Exception, match="Damaged"):
        read_records(spark, tmp_dir).collect()


def test_empty(spark):
    assert records_round_trip(documents(spark, []), PATH).collect() == []
