from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.byte_pair import RANKS, TextEncoder, TreeEncoder, load_ranks, token_digests

PATH = public_tokenizers.path(RANKS)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(PATH), special_tokens={})
TREE = TreeEncoder(load_ranks(PATH))
TEXTS = TextEncoder(TREE.encode)


def ids(text: str) -> list[int]:
    return np.frombuffer(TEXTS.packed(text), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text() | st.text(alphabet="ab the\n\t 1,.'sé漢\x1c\x85"))
def test_any_text(text):
    assert ids(text) == LIBRARY.encode_ordinary(text)
    assert TREE.decode(ids(text)) == text.encode()


def test_joins_at_any_boundary():
    rnd = random.Random(7)
    for _ in range(1500):
        data = "".join(rnd.choices(rnd.choice(["ab", "aeinorst", "a", "é漢字", "thequick"]), k=rnd.choice([2, 9, 40, 300])))
        cut = rnd.randrange(len(data) + 1)
        left, right = (TREE.encode(x.encode()) for x in (data[:cut], data[cut:]))
        assert list(TREE.join(left, right)) == LIBRARY._encode_single_piece(data.encode())


def test_long_texts():
    for text in ("a" * 30_000, "the quick  brown\n fox " * 4_000, "".join(random.Random(1).choices("aeinorst", k=30_000))):
        assert ids(text) == LIBRARY.encode_ordinary(text)


def test_frames(spark):
    rows = [(1, "One two", "x"), (1, "One two", "x"), (None, None, "y"), (3, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")

    def wanted(i, text):
        own = LIBRARY.encode_ordinary(text or "")
        packed = np.array(own, "<u4").tobytes()
        return str((i, len(own), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))

    assert sorted(str(tuple(r)) for r in token_digests(docs).collect()) == sorted(wanted(i, t) for i, t, _ in rows)
    assert token_digests(docs.limit(0)).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in token_digests(docs).collect():
        own = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(own), hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
