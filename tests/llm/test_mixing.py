from collections import defaultdict

from comarca.llm import mixing


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s] + 1e-6]
        if not over:
            return fixed | share
        fixed |= {s: 3.0 * sizes[s] for s in over}


def check(df, **options):
    sized = mixing.sizes(df)
    got = mixing.mix(sized, **options).collect()
    assert len(got) == df.count()
    sizes, taken, target, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in got:
        assert 0 <= r.copies <= 3
        sizes[r.source] += r.size
        taken[r.source] += r.copies * r.size
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    want = brute_targets(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-3 * max(1, want[s])
        assert abs(taken[s] - target[s]) <= 2 * largest[s] + 1
    return sorted(map(str, got))


def test_targets_and_reruns(docs):
    assert check(docs) == check(docs.repartition(7))


def test_odd_rows(odd_docs):
    check(odd_docs)


def test_several_levels(docs):
    check(docs, group_rows=4)


def test_empty(docs):
    assert mixing.mix(mixing.sizes(docs.where("false"))).count() == 0


def test_flight_keeps_both_totals():
    import random

    rng = random.Random(0)
    sizes = [float(rng.randint(1, 50)) for _ in range(500)]
    chance = [0.37] * 500
    left = mixing._flight(sizes, chance, list(range(500)), rng, 2)
    assert len(left) <= 2 and all(c in (0.0, 1.0) for i, c in enumerate(chance) if i not in left)
    assert abs(sum(chance) - 0.37 * 500) < 1e-6
    assert abs(sum(c * s for c, s in zip(chance, sizes)) - 0.37 * sum(sizes)) < 1e-4
