import math

import numpy as np
import pytest
from helpers import rows

from merchlens.operators import rerank
from merchlens.operators.similarity import similar_levels, similar_products, similars_of

TRIGGER = "trigger_id INT, user_id INT, product_id INT"
RECENT = "trigger_id INT, product_id INT, score DOUBLE"
RATED = "user_id INT, product_id INT"
SIMS = "product_id INT, sim_product_id INT, sim DOUBLE"
CANDIDATE = "trigger_id INT, user_id INT, candidate INT"


def reference(triggers, recents, rated, sims, k, floor):
    """Plain loops over the definition."""
    table = {}
    for a, b, s in sims:
        table.setdefault(a, {})[b] = s
    out = []
    for trigger, user, product in triggers:
        known = {p for u, p in rated if u == user}
        fresh = [(b, s) for b, s in table.get(product, {}).items() if b not in known]
        fresh.sort(key=lambda x: (-x[1], x[0]))
        for candidate, _ in fresh[:k]:
            hits = [
                (table[candidate][p], r)
                for t, p, r in recents
                if t == trigger and table.get(candidate, {}).get(p, 0.0) > floor
            ]
            if hits:
                up = sum(r > 3 for _, r in hits)
                down = sum(r <= 3 for _, r in hits)
                score = sum(s * r for s, r in hits) / len(hits)
                score += math.log10(max(up, 1)) - math.log10(max(down, 1))
                out.append((trigger, user, candidate, round(score, 9)))
    return sorted(out, key=repr)


def score(table, recents, sims, floor=0.6):
    candidates = table([(1, 1, 9)], CANDIDATE)
    scored = rerank.score_candidates(
        candidates, table([(1, *r) for r in recents], RECENT), table(sims, SIMS), floor
    )
    return [r.score for r in scored.collect()]


def test_worked_example(table):
    got = score(table, [(1, 5.0), (2, 4.0), (3, 2.0)], [(9, 1, 0.8), (9, 2, 0.7), (9, 3, 0.9)])
    assert got == [pytest.approx(3.167697, abs=1e-6)]


def test_floor_is_strict(table):
    assert score(table, [(1, 5.0)], [(9, 1, 0.6)]) == []


def test_rating_of_three_is_no_like(table):
    assert score(table, [(1, 3.0)], [(9, 1, 0.7)]) == [pytest.approx(2.1)]


def test_repeated_ratings_count_each(table):
    got = score(table, [(1, 5.0), (1, 4.0)], [(9, 1, 0.8)])
    assert got == [pytest.approx(0.8 * 4.5 + math.log10(2))]


def test_ties_and_rated_products(table):
    triggers = table([(1, 1, 5)], TRIGGER)
    sims = table([(5, 7, 0.9), (5, 3, 0.9), (5, 8, 0.95), (5, 2, 0.5)], SIMS)
    rated = table([(1, 8), (2, 7)], RATED)
    got = rerank.unrated_similars(triggers, rated, sims, 2)
    assert rows(got.select("candidate")) == [(3,), (7,)]


def test_unknown_product_gives_an_empty_list(table):
    triggers = table([(1, 1, 5), (2, 2, 99)], TRIGGER)
    sims = table([(5, 7, 0.9), (7, 4, 0.8)], SIMS)
    recents = table([(1, 4, 5.0), (2, 4, 5.0)], RECENT)
    rated = table([(1, 4), (2, 4)], RATED)
    scored = rerank.rerank(triggers, recents, rated, sims)
    lists = {r.user_id: r.recs for r in rerank.rerank_lists(triggers, scored).collect()}
    assert [x.product_id for x in lists[1]] == [7] and lists[2] == []


@pytest.fixture(scope="module")
def world():
    """A third of the triggers on product 0, a third of the ratings by user 0."""
    rng = np.random.default_rng(11)
    sims = {}
    for a in range(60):
        for b in rng.choice(60, size=45 if a == 0 else 15, replace=False):
            if a != b:
                sims[a, int(b)] = sims[int(b), a] = float(rng.choice([0.45, 0.65, 0.651, 0.7, 0.9]))
    triggers = [(t, t % 25, 0 if t % 3 == 0 else int(rng.integers(60))) for t in range(75)]
    rated = [(0 if rng.random() < 1 / 3 else int(rng.integers(25)), int(rng.integers(60))) for _ in range(200)]
    recents = [(t, int(rng.integers(60)), float(rng.integers(1, 6))) for t in range(75) for _ in range(8)]
    return triggers, recents, rated, [(a, b, s) for (a, b), s in sims.items()]


@pytest.mark.parametrize("k", [1, 5, 20])
@pytest.mark.parametrize("bounded", [False, True])
def test_against_loops(table, world, k, bounded):
    triggers, recents, rated, sims = world
    sims_df = table(sims, SIMS)
    scored = rerank.rerank(
        table(triggers, TRIGGER), table(recents, RECENT), table(rated, RATED), sims_df, k,
        levels=similar_levels(sims_df) if bounded else None,
    )
    got = [(r.trigger_id, r.user_id, r.product_id, round(r.score, 9)) for r in scored.collect()]
    assert sorted(got, key=repr) == reference(triggers, recents, rated, sims, k, 0.6)


def test_levels_cut_the_candidates(table):
    sims = [(0, b, (b + 0.5) / 1000) for b in range(1, 1000)]
    sims_df = table(sims, SIMS)
    triggers = table([(1, 1, 0)], TRIGGER)
    rated = table([(1, 999)], RATED)
    cut = rerank._wanted_levels(triggers, rated, similar_levels(sims_df), 20)
    assert sorted(r._level for r in cut.collect()) == list(range(979, 1000))
    got = rerank.unrated_similars(triggers, rated, sims_df, 20, similar_levels(sims_df))
    assert sorted(r.candidate for r in got.collect()) == list(range(979, 999))


def test_latest_trigger(table):
    events = table([(1, 5, 10), (1, 7, 10), (1, 9, 3), (2, 1, 1)], "user_id INT, product_id INT, ts BIGINT")
    assert rows(rerank.latest_triggers(events)) == [(1, 1, 7), (2, 2, 1)]


@pytest.mark.parametrize("k", [1, 5])
def test_lists_of_asked_products_and_vectors_give_the_scores_of_all_pairs(table, world, k):
    """Re-ranking needs no table of all pairs: the triggers' similars and the scored pairs do."""
    triggers, recents, rated, _ = world
    rng = np.random.default_rng(4)
    data = [(i, [float(x) for x in rng.normal(size=5)]) for i in range(60)]
    data[9] = (9, data[0][1])
    vectors = table(data, "product_id INT, features ARRAY<DOUBLE>")
    frames = table(triggers, TRIGGER), table(recents, RECENT), table(rated, RATED)
    all_pairs = similar_products(vectors, 0.1)
    sims = similars_of(rerank.wanted_depths(frames[0], frames[2], k), vectors, 0.1)
    assert sims.count() < all_pairs.count()
    got = rerank.rerank(*frames, sims, k, 0.2, similar_levels(sims), vectors=vectors)
    got = [(r.trigger_id, r.user_id, r.product_id, round(r.score, 9)) for r in got.collect()]
    pairs = [(r.product_id, r.sim_product_id, r.sim) for r in all_pairs.collect()]
    assert sorted(got, key=repr) == reference(triggers, recents, rated, pairs, k, 0.2)


def test_depth_of_a_product_is_its_greediest_users(table):
    triggers = table([(1, 1, 5), (2, 2, 5), (3, 3, 6), (4, None, 7), (5, 1, None)], TRIGGER)
    rated = table([(1, 5), (1, 5), (1, 6), (1, 7), (2, 5)], RATED)
    assert rows(rerank.wanted_depths(triggers, rated, 20)) == [(5, 23), (6, 20), (7, 20)]
