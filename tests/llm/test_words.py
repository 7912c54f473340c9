import numpy as np
import pyarrow as pa
from brute import ALPHANUMERIC, LOWER, SPACED
from hypothesis import given, settings
from hypothesis import strategies as st

from trustline.llm import words
from trustline.llm.words import ALPHANUMERIC_FOLDED, SPACED as SPACED_BYTES, SPACED_FOLDED, rolling, slices, whole

TEXTS = st.lists(st.text(alphabet=st.sampled_from("aAbZé 　 \t\n\x0b\x1c09_-漢"), max_size=30) | st.none(), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.sampled_from([1, 7, 1 << 20]))
def test_words_are_those_of_the_pattern(texts, limit):
    for letters, pattern, fold in ((SPACED_BYTES, SPACED, False), (SPACED_FOLDED, SPACED, True), (ALPHANUMERIC_FOLDED, ALPHANUMERIC, True)):
        seen, got = {}, []
        for part in slices(pa.array(texts, pa.string()), letters, limit):
            for row in range(part.count):
                own = [w.decode().translate(LOWER) if fold else w.decode() for w in part.words(row)]
                got.append(own)
                for w, h in zip(own, part.hashes[part.word_at[row] : part.word_at[row + 1]].tolist(), strict=True):
                    assert seen.setdefault(w, h) == h
        assert got == [pattern.findall((t or "").translate(LOWER) if fold else t or "") for t in texts]
        assert len(set(seen.values())) == len(seen)


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(words, "CHUNK", 16)
    text = "one two " + "x" * 50 + " three four five"
    (part,) = slices(pa.array([text]), SPACED_BYTES, 1 << 20)
    assert [w.decode() for w in part.words(0)] == text.split()


def test_sliced_arrays_and_runs():
    array = pa.array(["a b", None, "c d e", "f"])[1:]
    (part,) = slices(array, SPACED_BYTES)
    assert part.word_at.tolist() == [0, 0, 3, 4]
    runs = rolling(part.hashes, 2)[whole(part.word_at, len(part.hashes), 2)]
    (other,) = slices(pa.array(["c d e"]), SPACED_BYTES)
    assert np.array_equal(runs, rolling(other.hashes, 2))
