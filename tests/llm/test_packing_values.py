import math
import struct
import zlib
from collections import defaultdict

import public_tokenizers
from tokenizers import Tokenizer

from grovespark.llm import packing

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_equal_the_library_and_fill_the_sequences(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    tok, want = Tokenizer.from_file(WORDS), {}
    for r in docs.collect():
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            own = ids[at : at + 4096]
            want[r.doc_id, piece] = (at, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own)))
    rows = packing.pack_documents(docs, WORDS).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(length for _, length, _ in want.values())
    assert len(bins) <= math.ceil(total / 4096) + 1


def test_many_short_pieces_are_exchanged_too(spark):
    lengths = [7 + i % 5 for i in range(900)] + [2000 + i % 90 for i in range(40)]
    bins = packing.local_search(packing.best_fit(lengths, 4096), lengths, 4096)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert len(bins) <= math.ceil(sum(lengths) / 4096) + 1
