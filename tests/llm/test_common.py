import numpy as np

from lodestone.llm import common


def test_word_hashes_follow_words_not_places():
    table = common.word_table()
    a, n = common.word_hashes(["one two  three", "", "two", "öne,two"], table)
    assert n.tolist() == [3, 0, 1, 2]
    assert a[1] == a[3] == a[5] and len({int(x) for x in a}) == 4


def test_slices_cover_everything_once():
    sizes = [5, 0, 7, 100, 3, 3, 3]
    parts = list(common.slices(sizes, 10))
    assert [k for a, b in parts for k in range(a, b)] == list(range(len(sizes)))
    assert all(sum(sizes[a:b]) <= 10 or b - a == 1 for a, b in parts)
    assert list(common.slices([])) == []


def test_mixed_is_a_bijection_in_effect():
    x = np.arange(100_000, dtype=np.uint64)
    assert len(np.unique(common.mixed(x))) == len(x)
