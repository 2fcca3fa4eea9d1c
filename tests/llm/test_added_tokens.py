"""Ids of texts that hold an added token, as tokenizers gives them by default."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from martlight.llm import packing
from tests.llm.tables import documents

TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y\n", "no <|endof text|> here", "word <|endoftext|> " * 1500]


def test_added_tokens_are_one_id(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert len(tokenizer.encode(TEXTS[0], add_special_tokens=False).ids) == 4
    found = packing.packed_documents(documents(spark, [(i, t, "s") for i, t in enumerate(TEXTS)]), with_ids=True).collect()
    ids = {i: b"" for i in range(len(TEXTS))}
    for r in sorted(found, key=lambda r: (r.doc_id, r.piece)):
        assert r.ids_crc32 == zlib.crc32(r.ids) and r.length == len(r.ids) // 4 and r.start == len(ids[r.doc_id]) // 4
        ids[r.doc_id] += bytes(r.ids)
    for i, text in enumerate(TEXTS):
        expected = tokenizer.encode(text, add_special_tokens=False).ids + [packing.END_ID]
        assert np.frombuffer(ids[i], dtype="<u4").tolist() == expected
