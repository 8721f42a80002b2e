import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from marlstone.llm.packing import Packer, pack
from marlstone.llm.queries import op4_packing, tokenizer_path
from tests.llm.brute import empty_documents, odd_documents, rows

PATH = tokenizer_path("byte_bpe_50k.json")


def check(found, texts, length=1024):
    """Every id lies in one piece, sequences have no gaps, and only one sequence is short."""
    library = Tokenizer.from_file(PATH)
    ids = {i: np.array(e.ids + [0], "<u4") for i, e in zip(texts, library.encode_batch([t or "" for t in texts.values()], add_special_tokens=False), strict=True)}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert by_doc.keys() == ids.keys()
    for i, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids[i])
            assert r["ids_crc32"] == zlib.crc32(ids[i][at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids[i])
    short = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= length
        short += at < length
    assert short <= 1


def test_query_covers_every_id_once(spark, folder):
    check(op4_packing(spark, folder).collect(), {d["doc_id"]: d["text"] for d in rows(folder, "documents")})


def test_small_windows_over_many_partitions(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(80).repartition(7).cache()
    for windows in (1, 3):
        check(pack(docs, PATH, ["doc_id"], 0, length=64, open_windows=windows).collect(), {r["doc_id"]: r["text"] for r in docs.collect()}, 64)


def test_odd_documents(spark):
    df = odd_documents(spark).dropDuplicates(["doc_id"])
    out = pack(df, PATH, ["doc_id"], 0).collect()
    check(out, {r["doc_id"]: r["text"] for r in df.collect()})
    assert pack(empty_documents(spark), PATH, ["doc_id"], 0).collect() == []
    repeated = odd_documents(spark).filter("doc_id = 6")
    assert sum(r["length"] for r in pack(repeated, PATH, ["doc_id"], 0).collect()) == 3 * out[[r["doc_id"] for r in out].index(6)]["doc_tokens"]


def test_windows_are_bounded_and_best_fit():
    packer = Packer(length=10, open_windows=2)
    for key, size in enumerate([6, 7, 3, 4, 8, 5]):
        packer.add(key, b"\0" * 4 * size)
        assert len(packer.windows) <= 2
    # 3 fits best behind 7, 4 behind 6; then 8 and 5 are open
    full = packer.taken()
    assert [[(p[0], len(p[2]) // 4) for p in w] for w in full[:2]] == [[(1, 7), (2, 3)], [(0, 6), (3, 4)]]
    assert sum(len(p[2]) // 4 for p in packer.close()) < 10


def test_a_piece_that_fits_nowhere_fills_the_fullest_window():
    packer = Packer(length=10, open_windows=2)
    for key, size in enumerate([6, 8, 5]):
        packer.add(key, b"\0" * 4 * size)
    assert [(p[0], p[1], len(p[2]) // 4) for p in packer.taken()[0]] == [(1, 0, 8), (2, 0, 2)]
