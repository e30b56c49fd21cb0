"""Added tokens inside texts, against the vocabulary's own tokenizer as it is."""

import struct
import zlib

import numpy as np
import pytest

pytest.importorskip("loomwork.llm")
from loomwork.llm import packing  # noqa: E402

END = "<|endoftext|>"
TEXTS = [END, f"{END} x", f"a b{END}", f"a {END} b", f"{END}{END}", f"x\n{END}\n\ny", f"<|endoftext{END}|>", "<|endoftext|", f"é  {END}\tb"]


def test_added_tokens(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(packing.default_vocabulary())
    ids = [own.encode(t, add_special_tokens=False).ids for t in TEXTS]
    assert ids[0] == [50256]
    encoder = packing.Encoder(packing.default_vocabulary())
    assert [encoder.document(t) for t in TEXTS] == [np.array(i, "<u4").tobytes() for i in ids]
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: (r.length, r.ids_crc32) for r in packing.pack(docs).collect()}
    assert got == {k: (len(i) + 1, zlib.crc32(struct.pack(f"<{len(i) + 1}I", *i, 0))) for k, i in enumerate(ids)}
