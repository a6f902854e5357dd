"""The inner steps of the skip-gram fit."""

import numpy as np

from quillframe.plans import word_vectors as w


class Watched(np.ndarray):
    """Counts how often many elements of it are picked."""

    picks = 0

    def __getitem__(self, at):
        if isinstance(at, np.ndarray) and len(at) > 1000:
            Watched.picks += 1
        return super().__getitem__(at)


def test_a_part_is_packed_once_whatever_the_number_of_cells():
    rng = np.random.default_rng(1)
    words, owner = rng.integers(0, 600, 4000), np.repeat(np.arange(40), 100)
    block = np.repeat(np.arange(20), 30)
    at = np.tile(np.arange(30), 20).view(Watched)
    got = {}
    for batch in w._counted(words, owner, 3900, block, at, 20, 3):
        for row in batch.to_pylist():
            for l, r, n in zip(*(w._wide(row[c], row["size"]).tolist() for c in "lrw")):
                assert (row["i"], l, row["j"], r) not in got
                got[row["i"], l, row["j"], r] = n
    want = {}
    for k in range(3900):
        for d in range(1, 4):
            if k + d < 4000 and owner[k] == owner[k + d]:
                a, b = sorted((int(words[k]), int(words[k + d])))
                key = a // 30, a % 30, b // 30, b % 30
                want[key] = want.get(key, 0) + 4 - d
    assert got == want
    assert Watched.picks <= 2


def test_changes_of_a_word_are_added_up():
    rng = np.random.default_rng(2)
    for rows in (rng.zipf(1.3, 900) % 500, np.zeros(300, np.int64), np.arange(50), np.repeat(np.arange(9), np.arange(4, 13)), np.array([7])):
        change = rng.standard_normal((len(rows), 6)).astype(np.float32)
        at, total = w._summed(rows, change)
        assert sorted(at.tolist()) == sorted(set(rows.tolist()))
        for row, found in zip(at.tolist(), total):
            assert np.allclose(found, change[rows == row].sum(axis=0, dtype=np.float64), atol=1e-4)
