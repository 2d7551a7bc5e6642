import random

from corvane.llm.suffix import suffix_array


def plain(s):
    return sorted(range(len(s)), key=lambda i: s[i:])


def test_small_strings():
    for n in range(9):
        for k in range(3**n):
            s = [(k // 3**i) % 3 for i in range(n)]
            assert suffix_array(s) == plain(s)


def test_random_and_repetitive_strings():
    rng = random.Random(4)
    for _ in range(400):
        s = [rng.randrange(rng.choice((1, 2, 3, 50))) for _ in range(rng.randrange(120))]
        s = s * rng.randrange(1, 4)
        assert suffix_array(s) == plain(s)
    a, b = [0], [1]
    for _ in range(12):
        a, b = b, b + a
    assert suffix_array(b) == plain(b)


def test_long_runs_are_linear():
    n = 100_000
    assert suffix_array([7] * n) == list(range(n - 1, -1, -1))
    assert suffix_array(list(range(n))) == list(range(n))
    assert suffix_array(list(range(n, 0, -1))) == list(range(n - 1, -1, -1))
