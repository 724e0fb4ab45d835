import tracemalloc

import numpy as np
import pytest

from ledgerlens.llm import textkernel
from ledgerlens.llm.hashed_features import pieces, word_features
from ledgerlens.llm.textkernel import Hashes, spans, word_hashes


@pytest.mark.parametrize("seed", range(20))
def test_words_cut_into_pieces_have_their_whole_hash(monkeypatch, seed):
    draw = np.random.default_rng(seed)
    text = "".join(draw.choice(list("ab é日 ") if seed % 2 else list("abcdefg日é\n"), 400)).encode()
    whole = Hashes(text)
    s, e = spans(whole.codes, textkernel.IN_WORD)
    monkeypatch.setattr(textkernel, "CHUNK_BYTES", int(draw.integers(4, 40)))
    found = word_hashes(text)
    assert [x.tolist() for x in found] == [whole.of(s, e).tolist(), s.tolist(), e.tolist()]
    cut = list(pieces(text))
    assert b"".join(cut) == text and all(p.decode() for p in cut)
    assert max(map(len, cut)) < 2 * textkernel.CHUNK_BYTES


def test_an_unbroken_word_takes_bounded_memory():
    text = b"x" * 50_000_000
    for work in (lambda: word_hashes(text), lambda: word_features(text, 16, (4,), True, (3,))):
        tracemalloc.start()
        work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 300_000_000
    h, s, e = word_hashes(text + b" y")
    assert (s.tolist(), e.tolist()) == ([0, 50_000_001], [50_000_000, 50_000_002])


def test_groups_of_texts_take_bounded_memory():
    texts = [f"{i} ".encode() + b"some words of a text " * 500 for i in range(200)]
    tracemalloc.start()
    found = [h[lo:hi].sum() for _, _, h, _, _, _, at in textkernel.documents_words(texts) for lo, hi in zip(at[:-1], at[1:])]
    kept, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert found == [word_hashes(t)[0].sum() for t in texts]
    assert kept < 15_000_000 and peak < 40_000_000
