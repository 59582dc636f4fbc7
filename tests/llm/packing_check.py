"""What must hold for any packing."""

from __future__ import annotations

import zlib

import numpy as np
from tokenizers import Tokenizer

from millrace.llm.queries import word_tokenizer


def check_packing(pieces, texts, sequence=4096):
    theirs = Tokenizer.from_str(word_tokenizer())
    by_id = {}
    for p in pieces:
        by_id.setdefault(p["doc_id"], []).append(p)
    assert set(by_id) == set(texts)
    for doc_id, own in by_id.items():
        ids = np.array(theirs.encode(texts[doc_id] or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    places = sorted((p["sequence_id"], p["offset"], p["length"]) for p in pieces)
    ends = {}
    for number, offset, length in places:
        assert ends.get(number, 0) == offset
        ends[number] = offset + length
    assert max(ends.values()) <= sequence
    return sum(ends.values()), len(ends)
