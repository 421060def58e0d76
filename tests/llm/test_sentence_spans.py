from collections import defaultdict

import numpy as np

from freshcat.llm import sentence_spans as P
from freshcat.llm.common import table

SCHEMA = "doc_id long, text string, whole string, th string"


def brute(rows):
    """(id, text left, first ids) by comparing the runs' words themselves."""
    docs, places = {}, defaultdict(set)
    for i, t in rows:
        units = P.sentences(t or "")
        key = (i is None, i if i is not None else 0, P_hash(t or ""))
        docs[(i, t or "")] = (units, key)
        for k, (a, n, _) in enumerate(P.runs(units)):
            places[" ".join(" ".join(u[2]) for u in units[a:a + n])].add((*key, k))
    out = []
    for i, t in rows:
        units, key = docs[(i, t or "")]
        gone, first = set(), set()
        for k, (a, n, _) in enumerate(P.runs(units)):
            least = min(places[" ".join(" ".join(u[2]) for u in units[a:a + n])])
            if least != (*key, k):
                gone.update(range(a, a + n))
                if not least[0]:
                    first.add(least[1])
        out.append((str(i), "".join((t or "")[u[0]:u[1]] for k, u in enumerate(units) if k not in gone) if gone else t or "", sorted(first)))
    return sorted(out)


def P_hash(text):
    import xxhash

    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def prose(rng, n):
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(1, 8))) for _ in range(n)]
    return "".join(w + (str(rng.choice([".", "!\n", "?"])) if rng.random() < 0.15 else "") + " " for w in words)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    passage = prose(rng, 55)
    texts = [None, "", " \n ", "One. Two. Three.", "One. Two. Three.", "No stop at all " * 40, passage, "a. " * 40]
    for _ in range(25):
        texts += [prose(rng, 30) + ". " + passage + prose(rng, 20), prose(rng, 60)]
    rows = [(None if k in (3, 20) else 100 - k, t) for k, t in enumerate(texts)] + [(1, texts[9]), (1, texts[9])]
    got = P.remove_repeated_spans(spark.createDataFrame([(*r, "clash", "") for r in rows], SCHEMA)).collect()
    assert sorted((str(r.doc_id), r.text, list(r.first_doc_ids)) for r in got) == brute(rows)
    for r in got:
        assert r.n_bytes - r.n_removed == len(r.text.encode())
    assert P.remove_repeated_spans(spark.createDataFrame([], SCHEMA)).collect() == []


def test_units_cover_the_text_and_long_ones_are_cut():
    rng = np.random.default_rng(6)
    for text in [prose(rng, 200), "x " * 100, "\n\n a. b\n", "a.b c. ", "é" * 10]:
        units = P.sentences(text)
        assert "".join(text[a:b] for a, b, _ in units) == text
        assert all(0 < len(w) <= P.MAX_SENTENCE_WORDS for _, _, w in units)


def test_runs_are_shortest_from_and_to_each_unit():
    rng = np.random.default_rng(7)
    for _ in range(30):
        units = P.sentences(prose(rng, int(rng.integers(0, 60))))
        words, n = [len(u[2]) for u in units], len(units)
        able = lambda i, j: j - i >= P.SPAN and sum(words[i:j]) >= P.MIN_SPAN_WORDS
        want = {next(((i, j - i) for j in range(i, n + 1) if able(i, j)), None) for i in range(n)}
        want |= {next(((i, j - i) for i in range(j, -1, -1) if able(i, j)), None) for j in range(n + 1)}
        assert [r[:2] for r in P.runs(units)] == sorted(want - {None})


def test_query_equals_brute_force(spark):
    from freshcat.llm.queries import op8_sentence_spans

    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, folder, "documents").select("doc_id", "text").collect()]
    got = op8_sentence_spans(spark, folder).collect()
    assert sorted((str(r.doc_id), r.text, list(r.first_doc_ids)) for r in got) == brute(rows)


def test_a_passage_in_two_documents_stays_only_in_the_first(spark):
    rng = np.random.default_rng(8)
    passage = "Start here. " + prose(rng, 60) + "end it. "
    docs = spark.createDataFrame([(k, prose(rng, 40) + ". " + passage + prose(rng, 30), "", "") for k in range(5)], SCHEMA)
    got = {r.doc_id: r for r in P.remove_repeated_spans(docs).collect()}
    assert got[0].n_removed == 0
    assert all(got[k].n_removed >= 0.8 * len(passage) and 0 in got[k].first_doc_ids for k in range(1, 5))


def gone_words(text, words, length=50):
    """Word numbers of ``text`` in a run of ``length`` words that ``words`` has too."""
    own = text.lower().split()
    known = {tuple(words[i:i + length]) for i in range(len(words) - length + 1)}
    return {k for i in range(len(own) - length + 1) if tuple(own[i:i + length]) in known for k in range(i, i + length)}


def test_repeats_of_50_words_at_every_offset(spark):
    """Passages without a stop, with one near the end, or in prose, beginning at each offset of
    a long sentence, found by comparing words: most of each goes, and no word of another place."""
    rng = np.random.default_rng(9)
    fresh = lambda n: ["w" + "".join(rng.choice(list("abcdefghij"), 7)) for _ in range(n)]
    plain, late, middle = fresh(50), fresh(60), fresh(50)
    late[50] += "."
    middle[24] += "?"
    rows = [(0, " ".join(fresh(5) + plain + fresh(9) + late + fresh(7) + middle + fresh(4)))]
    for k in range(26):
        rows += [(100 * n + k + 1, " ".join(fresh(k) + p + fresh(30 - k))) for n, p in enumerate((plain, late, middle))]
    got = {r.doc_id: r for r in P.remove_repeated_spans(spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA)).collect()}
    assert got[0].n_removed == 0
    first = rows[0][1].lower().split()
    for i, text in rows[1:]:
        repeated = gone_words(text, first)
        assert len(repeated) >= 50
        words = text.lower().split()
        left = got[i].text.lower().split()
        assert set(words) - set(left) <= {words[k] for k in repeated}  # fresh words are all different
        assert len(words) - len(left) >= len(repeated) - 2 * (P.CUT_WORDS - 1), i
        assert 0 in got[i].first_doc_ids


def test_repeats_in_text_without_white_space(spark):
    rng = np.random.default_rng(10)
    for low, high in ((0x4E00, 0x9FA5), (0x3041, 0x3096), (0x61, 0x7A)):
        fresh = lambda n: "".join(map(chr, rng.integers(low, high, n)))  # noqa: B023, E731
        passage = fresh(50)
        # the characters beside the passage differ, so that it is just 50 long
        rows = [(k, fresh(200 + k) + chr(0x430 + k) + passage + chr(0x430 + k) + fresh(89)) for k in range(15)]
        got = {r.doc_id: r for r in P.remove_repeated_spans(spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA)).collect()}
        assert got[0].text == rows[0][1]
        for k in range(1, 15):
            at = len(rows[k][1]) - 90 - 50
            assert got[k].text.startswith(rows[k][1][:at]) and got[k].text.endswith(rows[k][1][-90:])
            assert 50 - 2 * (P.CUT_WORDS - 1) <= len(rows[k][1]) - len(got[k].text) <= 50


def test_equal_passages_are_cut_alike_at_every_phase():
    rng = np.random.default_rng(11)
    for pool in (3, 40, 10**6):
        for _ in range(40):
            passage, inner = [f"w{x}" for x in rng.integers(0, pool, 50)], set()
            for k in range(13):
                cuts = P.content_cuts([f"x{x}" for x in rng.integers(0, 99, k)] + passage + ["y"] * 9)
                assert max(b - a for a, b in zip([0, *cuts], [*cuts, k + 59])) <= P.CUT_WORDS
                inner.add(tuple(c - k for c in cuts if P.CUT_WORDS - 1 <= c - k <= 50 - P.CUT_WORDS))
            assert len(inner) == 1
