"""Token ids of texts that hold strings of added tokens, against the library as it comes."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from eventmart.llm import packing

JSON = public_tokenizers.path("byte_bpe_50k.json")
END = "<|endoftext|>"
TEXTS = [
    f"a {END} b",
    END,
    f"{END}{END}",
    "",
    f"one  {END}  two\n\n{END}\n three",
    "no such token, <|endoftext| nearly",
    None,
    "é" * 3 + END + "日本語 🤗" + END[:5],
    "many words " * 120_000 + END + " and more " * 120_000,
    "last",
]


def test_added_tokens_are_those_of_the_library(spark):
    reference = Tokenizer.from_file(JSON)
    want = [[*reference.encode(t or "", add_special_tokens=False).ids, 2] for t in TEXTS]
    with open(JSON, encoding="utf-8") as file:
        got = list(packing.token_bytes(TEXTS, file.read(), 2))
    assert [i for i, _ in got] == list(range(len(TEXTS)))
    assert [np.frombuffer(b, "<u4").tolist() for _, b in got] == want
    assert 50256 in want[0]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS[:8])], "doc_id long, text string")
    pieces = {r.doc_id: r.token_ids for r in packing.token_pieces(docs, JSON, ids=True).collect()}
    assert [pieces[i] for i in range(8)] == want[:8]
