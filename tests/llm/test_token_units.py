"""Token ids put together from units, against the library's ids of whole texts."""

import random

import pyarrow as pa
import pytest

from ferrule.llm import records
from ferrule.llm.common import slices


def test_units_equal_whole_texts():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    enc = records.UnitEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    parts = ["a", "don't", "'s", "we'll", "l'ê", "'", ",", ".", "-", "_", ")(", "...", "é", "É", "×", "÷", "ª", "º", "²", "½", "日本", "’", "“", "€", "̀a",
             "ñ", "<|endoftext|>", "<|endo", "|>", " ", "  ", "\n", "\t\n ", " ", " ", "　", "x1", "42,000.5", "http://a.b/c?d=e&f", "😀", "\x1c",
             "\x00", "\x7f", "​"]
    plain = [p for p in parts if p not in ("<|endoftext|>", " ", " ", "　", "\x1c")]
    r = random.Random(5)
    texts = [None, "", " ", ","] + ["".join(r.choice(parts if i % 3 == 0 else plain) for _ in range(r.randint(0, 40))) for i in range(4000)]
    got = [x.tolist() for _, _, data, off in slices(pa.array(texts), 1 << 14) for x in enc.encode(data, off)]
    assert got == [enc.tok.encode(t or "", add_special_tokens=False).ids for t in texts]
