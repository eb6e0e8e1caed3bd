import os
import random
import uuid
from itertools import combinations

import numpy as np

from cohortlens.llm import bitmap_join as bj
from cohortlens.llm import shared
from cohortlens.llm.components import components

from .small import mirrored_words, odd_documents, prose, save

FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def sets_of(rows):
    out = []
    for i, t, *_ in rows:
        w = (t or "").encode().translate(FOLD).split()
        out.append((i, frozenset(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else frozenset([tuple(w)] if w else [])))
    return out


def brute(rows):
    sets = sets_of(rows)
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        both = len(x & y)
        if x and y and 100 * both >= 75 * (len(x) + len(y) - both):
            up[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, len(s), least[find(k)] if s else i) for k, (i, s) in enumerate(sets))


def run(spark, folder):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in bj.op9_bitmap_join(spark, folder).collect())


def edited(rng, words, n):
    w = list(words)
    for _ in range(n):
        k = rng.randrange(len(w))
        w[k : k + 1] = rng.choice([[], [prose(rng, 1)], [prose(rng, 1), w[k]]])
    return " ".join(w)


def groups(rng, start, n_groups, most):
    rows, i = [], start
    for _ in range(n_groups):
        base = prose(rng, rng.randint(6, 150)).split()
        for _ in range(rng.randint(1, most)):
            rows.append((i, edited(rng, base, rng.randint(0, max(1, len(base) // 20))), "en", "a"))
            i += 1
    rng.shuffle(rows)
    return rows


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(1)
    rows = odd_documents() + groups(rng, 100, 25, 12)
    rows += [(900, rows[-1][1].upper(), "en", "a"), (101, rows[-1][1], "en", "a"), (901, "One two three", "en", "a"), (902, "one  TWO\tthree", "en", "a")]
    assert run(spark, save(spark, tmp_path, rows)) == brute(rows)


def test_chains_in_larger_tiles(spark, tmp_path, monkeypatch):
    """Neighbours of a chain are linked, its ends are not; a common passage joins nothing."""
    monkeypatch.setattr(bj, "SMALL_TILE", 2)
    rng = random.Random(2)
    words = prose(rng, 80).split()
    rows = []
    for k in range(14):
        rows.append((50 - k, " ".join(words), "en", "a"))
        words = words[4:] + prose(rng, 4).split()
    passage = prose(rng, 40)
    rows += [(100 + k, passage + " " + prose(rng, 45), "en", "a") for k in range(30)]
    assert run(spark, save(spark, tmp_path, rows)) == brute(rows)


def test_large_tiles_are_cut_into_pairs_of_blocks(spark, tmp_path, monkeypatch):
    """A passage that most documents share, unlinked, with linked groups among them: every pair of blocks is looked at."""
    monkeypatch.setattr(bj, "SMALL_TILE", 2)
    monkeypatch.setattr(bj, "BLOCK_NODES", 5)
    rng = random.Random(6)
    passage = prose(rng, 60)
    rows = [(k, passage + " " + prose(rng, 50), "en", "a") for k in range(60)]
    for k in range(20):  # near copies of some, far apart in id
        words = rows[3 * k][1].split()
        words[rng.randrange(len(words))] = "changed"
        rows.append((500 - k, " ".join(words), "en", "a"))
    rows += [(1000 + k, rows[5][1], "en", "a") for k in range(30)]
    expected = brute(rows)
    assert run(spark, save(spark, tmp_path, rows)) == expected
    monkeypatch.setattr(bj, "TASK_PLACES", 40)
    assert run(spark, save(spark, tmp_path / "b", rows)) == expected


def test_copies_are_packed_once(spark):
    """Copies of a text add no keys to a batch's buckets."""
    rng = random.Random(4)
    text = prose(rng, 40)
    df = bj.keyed(spark.createDataFrame([(k, text if k % 3 else prose(rng, 40)) for k in range(60)], "doc_id long, text string"))
    found = bj.profiles(df.coalesce(1), np.zeros(0, np.uint64))
    packed = bj._packed(found, 4).collect()
    assert sum(len(r.nodes) // 8 for r in packed) <= 4 * 21


def test_mirrored_words_are_two(spark, tmp_path):
    rows = [(k, w, "en", "a") for k, w in enumerate(w for n in (512, 1024, 2048) for w in mirrored_words(n))]
    assert run(spark, save(spark, tmp_path, rows)) == brute(rows)


def test_order_of_shingles_changes_nothing(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    rows = groups(rng, 0, 12, 10)
    folder = save(spark, tmp_path, rows)
    one = run(spark, folder)
    monkeypatch.setattr(bj, "frequent_shingles", lambda docs: np.sort(rng_some(rows)))
    assert run(spark, folder) == one == brute(rows)


def rng_some(rows):
    import pyarrow as pa

    values, _ = bj.shingle_sets(bj.read_texts(pa.array([t for _, t, *_ in rows]), lower_ascii=True))
    return np.unique(values)[::3]


def test_bitmaps_never_bound_below_the_overlap():
    rng = np.random.default_rng(4)
    for _ in range(300):
        n, extra = int(rng.integers(1, 400)), int(rng.integers(0, 120))
        pool = rng.integers(0, 1 << 62, n + extra).astype(np.uint64)
        a, b = np.unique(pool[:n]), np.unique(pool[extra:])
        x, y = bj.bitmap(a), bj.bitmap(b)
        w = min(len(x), len(y))
        x, y = bj.folded(x, w), bj.folded(y, w)
        only_a, only_b = int(np.bitwise_count(x & ~y).sum()), int(np.bitwise_count(y & ~x).sum())
        both = len(np.intersect1d(a, b))
        assert both <= min(len(a) - only_a, len(b) - only_b)
        if bj.linked(a, b):
            assert bj.may_link(len(a), len(b), only_a, only_b)


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 90), (90, 95), (7, 7)], "u long, v long")
    found = {r.node: r.label for r in components(links).collect()}
    assert found == {**{k: 0 for k in range(41)}, 90: 90, 95: 90, 100: 90}


def test_empty(spark, tmp_path):
    assert run(spark, save(spark, tmp_path, [])) == []


def test_a_row_without_an_id_joins_its_neighbours(spark, tmp_path):
    """1 ~ null ~ 2, where 1 and 2 are not linked; a set held by null ids alone; its copies."""
    words = prose(random.Random(8), 60).split()
    shifted = [" ".join(words[k : k + 46]) for k in (0, 5, 10)]
    rows = [(1, shifted[0], "en", "a"), (None, shifted[1], "en", "a"), (None, shifted[1], "en", "a"), (2, shifted[2], "en", "a")]
    alone = prose(random.Random(9), 30)
    rows += [(None, alone, "en", "a"), (None, alone + " end", "en", "a"), (None, None, "en", "a")]
    a, _, _, b = (s for _, s in sets_of(rows[:4]))
    assert 100 * len(a & b) < 75 * len(a | b)
    found = bj.op9_bitmap_join(spark, save(spark, tmp_path, rows)).collect()
    want = [(i, len(s), None if k > 3 else 1) for k, (i, s) in enumerate(sets_of(rows))]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


def common_words(rng, n):
    """Documents of a few common words around words of their own: no two share a passage, many share short runs."""
    return [(k, " ".join([rng.choice(["of", "the", "and", "a"]) for _ in range(40)] + [prose(rng, 1) + f"x{k}y{j}" for j in range(20)]), "en", "a") for k in range(n)]


def test_common_words_make_no_tiles(spark, tmp_path, monkeypatch):
    """First shingles are of rare words, so tiles do not grow with the documents that share common ones."""
    rows = common_words(random.Random(21), 60)
    monkeypatch.setattr(bj, "frequent_shingles", lambda docs: np.zeros(0, np.uint64))
    made, stored = {}, bj.stored

    def noted(df, name):
        out = stored(df, name)
        made[name] = out.count()
        return out

    monkeypatch.setattr(bj, "stored", noted)
    assert run(spark, save(spark, tmp_path, rows)) == brute(rows)
    assert made["tiles"] == 0 and made["texts"] == 0


def test_folders_go_after_their_last_reader(spark, tmp_path, monkeypatch):
    rows = groups(random.Random(22), 0, 6, 12)
    monkeypatch.setattr(bj, "SMALL_TILE", 2)
    there, stored, folder = {}, bj.stored, tmp_path / "shared"
    folder.mkdir()

    def noted(df, name):
        there[name] = {f.rpartition(".")[0] for f in os.listdir(folder)}
        return stored(df, name)

    monkeypatch.setattr(bj, "stored", noted)
    monkeypatch.setattr(shared, "shared_folder", lambda spark, name: f"{folder}/{name}.{len(os.listdir(folder))}-{uuid.uuid4().hex}")
    assert run(spark, save(spark, tmp_path, rows)) == brute(rows)
    assert "profiles" in there["tiles"] and "profiles" not in there["pairs"] | there["texts"]
    assert there["labels-0"] and not {"dealt", "tile-bits"} & there["labels-0"]
    assert {f.rpartition(".")[0] for f in os.listdir(folder)} == {"near-components"}
