"""The training-data operators against brute force, round trips and held-out labels on small tables."""

import hashlib
import html
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import bpe, chat, language_ecoc, minhash, mixing, neighbours, quality_pu, rules_forest, style_tree, suffix_dedup
from tidemark.llm.common import prepare, table
from tidemark.llm.queries import QUERIES, rank_file

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, extra string, size long"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(6000))


@pytest.fixture(scope="module")
def session(spark):
    return prepare(spark)


@pytest.fixture(scope="module")
def odd(session):
    """Empty, NULL, long and repeated texts, NULL columns, and columns named as those that operators add."""
    shared = " ".join(f"shared{i}" for i in range(120))
    rows = [
        (1, None, "en", "a", "x", 1), (2, "", "en", None, None, None), (3, " \t\n ", None, "a", "x", 1),
        (4, "one two", "en", "b", "x", 1), (5, "one two", "de", "b", "x", 1), (6, LONG, "en", "c", "x", 1),
        (6, LONG, "en", "c", "x", 1), (7, f"before it {shared} after", "de", "a", "x", 1),
        (8, f"other start {shared} different end", "de", None, "x", 1), (9, "aé漢 " * 300, None, None, "x", 1),
        (None, "no key at all here", "en", "a", "x", 1), (10, "12345 678", "en", "a", "x", 1),
    ]
    return session.createDataFrame(rows, DOCS)


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# repeated passages


def brute_repeats(rows, length=suffix_dedup.LENGTH):
    raws = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[p : p + length] for _, t in raws for p in range(len(t) - length + 1))
    out = []
    for i, t in raws:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches", [1, 4])
def test_repeats_equal_brute_force(odd, batches):
    found = suffix_dedup.remove_repeats(odd, batches=batches)
    assert sorted(map(tuple, found.collect()), key=str) == brute_repeats(texts(odd))


def test_repeats_at_all_offsets(session):
    random = np.random.default_rng(5)
    noise = lambda n: "".join(map(chr, random.integers(97, 123, n)))
    passage, unit = noise(700), noise(37)
    rows = [(i, noise(50 + 13 * i) + passage[i * 9 : 640 + i] + noise(30 * i)) for i in range(12)]
    rows += [(20, unit * 40), (21, noise(90) + unit * 13), (22, noise(399)), (23, passage[:400]), (24, passage[1:400])]
    docs = session.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, suffix_dedup.remove_repeats(docs).collect()), key=str) == brute_repeats(rows)


def test_repeats_keep_columns_and_whole_characters(odd):
    left = suffix_dedup.without_repeats(odd)
    assert left.columns == odd.columns
    by_key = {r.doc_id: r.text for r in left.collect()}
    assert by_key[1] is None and by_key[4] == "one two" and by_key[6] == "" and by_key[7].startswith("before i")


def test_index_levels_merge_geometrically(session):
    index = suffix_dedup.SuffixIndex()
    sizes = []
    for i in range(4):
        index.add(session.range(i, i + 2).select(F.col("id").alias("print"), (F.col("id") + 1).alias("print2")))
        sizes.append([x is not None for x in index.levels])
    assert sizes == [[True], [False, True], [True, True], [False, False, True]]
    assert sorted(r.print for r in index.levels[2].collect()) == [0, 1, 2, 3, 4]


# near-duplicates


def brute_components(rows, size, similar):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        n = min(size, len(words))
        sets.append(frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1)) if words else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= similar * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    out = []
    for i, (key, _) in enumerate(rows):
        keys = [k for k in groups[find(i)] if k is not None]
        least = min(keys) if keys else None
        out.append((key, len(sets[i]), least, key == least))
    return sorted(out, key=str)


@pytest.mark.parametrize(("size", "similar"), [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(session, odd, size, similar):
    random = np.random.default_rng(2)
    base = [f"t{x}" for x in random.integers(0, 500, 150)]
    rows = texts(odd)
    for i in range(80):  # variants of one text at all distances from it
        words = list(base)
        for at in random.integers(0, len(words), i // 8):
            words[at] = f"v{random.integers(0, 9)}"
        rows.append((100 + i, " ".join(words)))
    docs = session.createDataFrame(rows, "doc_id long, text string")
    found = minhash.near_duplicates(docs, size=size, similar=similar)
    assert sorted(map(tuple, found.collect()), key=str) == brute_components(rows, size, similar)


def test_one_of_each_group_stays(odd):
    left = minhash.keep_one(odd)
    assert left.columns == odd.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(map(str, [1, 2, 3, 4, 6, 7, 9, None, 10]))


def test_columns_may_have_any_name(session, odd):
    names = ["gone", "gone_hash", "key", "hash", "row", "own_key", "uid", "uid2", "raw", "runs"]
    named = odd.select("doc_id", "text", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    for left in (minhash.keep_one(named), suffix_dedup.without_repeats(named)):
        assert left.columns == named.columns
        assert {tuple(r)[2:] for r in left.collect()} == {tuple(range(len(names)))}


def test_rows_are_told_apart_by_key_and_text(session):
    random = np.random.default_rng(6)
    one, two, three, four = (" ".join(f"{c}{x}" for x in random.integers(0, 500, 150)) for c in "abcd")
    near = f"{four} end"
    rows = [
        (1, one), (None, one), (None, "no other row has this text"),  # a copy without key beside a row of its own
        (2, two), (3, two), (3, three), (5, three), (3, three),  # one key with two texts, the first a copy of another key
        (None, four), (None, near), (7, f"{one} end"),
    ]
    docs = session.createDataFrame(rows, "doc_id long, text string")
    found = minhash.near_duplicates(docs)
    assert sorted(map(tuple, found.collect()), key=str) == brute_components(rows, 5, 80)
    left = Counter(texts(minhash.keep_one(docs)))
    assert sum(left[None, x] for x in (four, near)) == 1  # one of two near copies without key
    assert left - Counter({(None, four): 1, (None, near): 1}) == Counter([rows[0], rows[2], rows[3], rows[5]])


def test_two_classes_of_one_key_keep_their_own_links(session):
    random = np.random.default_rng(7)
    one, two = (" ".join(f"{c}{x}" for x in random.integers(0, 500, 150)) for c in "ab")
    rows = [(1, one), (1, two), (8, f"{one} end"), (9, f"{two} end"), (None, f"{two} close"), (4, "alone here")]
    docs = session.createDataFrame(rows, "doc_id long, text string")
    found = minhash.near_duplicates(docs)
    assert sorted(map(tuple, found.collect()), key=str) == brute_components(rows, 5, 80)
    assert Counter(texts(minhash.keep_one(docs))) == Counter([rows[0], rows[1], rows[5]])


def test_estimates_are_near_the_similarity():
    random = np.random.default_rng(4)
    common = random.integers(0, 2**63, 800, dtype=np.uint64)
    sets = [np.unique(np.concatenate([common, random.integers(0, 2**63, 100, dtype=np.uint64)])) for _ in range(2)]
    words = [np.frombuffer(minhash.sketch(s, 24)[0], np.uint64) for s in sets]
    assert abs(float(minhash.estimates(*words)) - 0.8) < 0.2


# encoding


@pytest.fixture(scope="module")
def vocabulary():
    path, pattern = rank_file()
    return bpe.Vocabulary(bpe.read_ranks(path), pattern)


@pytest.fixture(scope="module")
def reference(vocabulary):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=rank_file()[1], mergeable_ranks=vocabulary.ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab sdé漢\n\t 1!'|<>_endoftext　", max_size=60), max_size=5))
def test_bpe_equals_tiktoken(vocabulary, reference, some):
    ids = vocabulary.encode_batch(some)
    assert ids == [reference.encode_ordinary(t) for t in some]
    assert [vocabulary.decode(x) for x in ids] == [t.encode() for t in some]


def test_bpe_of_long_pieces(vocabulary, reference):
    some = ["a" * 3000, "ab" * 700, " " * 2000, "é" * 300, "xyz\n \n" * 200, LONG[:20000], "q" * 256, "q" * 257, "ab" * 2600]
    assert vocabulary.encode_batch(some) == [reference.encode_ordinary(t) for t in some]


def test_bpe_cuts_the_words_of_a_batch_at_once(vocabulary, reference, monkeypatch):
    calls = []

    class Counting:
        def findall(self, text, pattern=vocabulary.pattern):
            calls.append(text)
            return pattern.findall(text)

    monkeypatch.setattr(vocabulary, "pattern", Counting())
    some = [" ".join(f"Wörter{i}x{j}." for j in range(50)) + " zwei\nZeilen" for i in range(40)]
    assert vocabulary.encode_batch(some) == [reference.encode_ordinary(t) for t in some]
    assert len(calls) <= 1 + len(some) + 1  # all parts after a space, each first part, the one with a line break


def test_bpe_of_every_white_space(vocabulary, reference):
    spaces = [chr(i) for i in range(0x3001) if chr(i).isspace()] + ["\u180e", "\u200b", "\ufeff"]
    some = [f"{a}x{b} y {a}{b}z {a} {b}" for a in spaces for b in spaces] + spaces + ["", " ", "  ", " a", "a ", None]
    assert vocabulary.encode_batch(some) == [reference.encode_ordinary(t or "") for t in some]


@pytest.mark.parametrize(("pieces", "size"), [(30, 16_000_000), (200_000, 0)])
def test_bpe_remembers_only_so_many_pieces(vocabulary, reference, monkeypatch, pieces, size):
    monkeypatch.setattr(bpe, "CACHED", pieces)
    monkeypatch.setattr(bpe, "CACHED_BYTES", size)
    for i in range(12):
        some = [f"qwx{i % 5}zvbn qx{j}vk{i % 7}zz" for j in range(4)] + ["q" * 300]
        assert vocabulary.encode_batch(some) == [reference.encode_ordinary(t) for t in some]
        assert len(vocabulary.known) <= len(vocabulary.tokens) + (pieces if size else 0)


def test_bpe_of_odd_rows(odd, reference):
    rows = bpe.digest(odd, *rank_file(), ["doc_id", "text"]).collect()
    assert len(rows) == odd.count()
    for r in rows:
        ids = reference.encode_ordinary(r.text or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_encode_and_decode_as_tables(odd):
    encoded = bpe.encode(odd, *rank_file(), ["doc_id", "text"])
    assert encoded.where("not intact").count() == 0
    decoded = bpe.decode(encoded, *rank_file(), ["doc_id", "text"])
    assert all(bytes(r.raw) == (r.text or "").encode() for r in decoded.collect())


# mixing


def test_targets_reshare_what_is_over_the_limit():
    out = mixing.targets({"b": 100, "a": 10, None: 50, "c": 0})
    assert out == {"a": 30.0, "c": 0.0, "b": pytest.approx(130 * 2 / 7), None: pytest.approx(130 * 5 / 7)}


def test_flow_prefers_fresh_documents_and_shares_overlaps():
    given_ = mixing.flow([(("a",), 10), (("a", "b"), 10)], {"a": 12.0, "b": 8.0})
    assert sum(given_[0].values()) == pytest.approx(10) and given_[1] == {"a": pytest.approx(2), "b": pytest.approx(8)}


def test_mix_comes_near_its_targets(session):
    rows = QUERIES["op5_mix"](session, "/root/testdata/sf0.01")
    docs = table(session, "/root/testdata/sf0.01", "documents").select("doc_id", "source")
    found = rows.join(docs, "doc_id").groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("w"))
    assert rows.where("taken > 3 * size or taken % greatest(size, 1) != 0").count() == 0
    assert all(abs(r.t / r.w - 1) < 0.01 for r in found.collect())


def test_mix_of_odd_rows(odd):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.taken <= 3 * r["size"] for r in rows)
    again = mixing.mix(odd).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


# rules


def brute_repeated_words(words):
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    return len(covered)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60))
def test_repeated_words(words):
    assert rules_forest.repeated_words(words) == brute_repeated_words(words)


def test_repeated_words_of_many_different():
    words = LONG.encode().split()
    assert rules_forest.repeated_words(words + words[100:300]) == 400


def test_rule_counts():
    values, _ = rules_forest.counts("a b|c\n\nx\nx\n \nx é漢 #*\v<")
    assert values == [8, 12, 4, 1, 0]


def test_rules_reject_poor_and_keep_clean_rows(session):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op6_rules"](session, folder).join(table(session, folder, "labels"), "doc_id")
    clean, poor = (found.where(F.col("quality") == q) for q in (1, 0))
    assert clean.where("kept").count() >= 0.95 * clean.count()
    assert poor.where("not kept").count() >= 0.6 * poor.count()


def test_rules_of_odd_rows(session, odd):
    labels = session.createDataFrame([(7, 1), (None, 0), (8, None)], "doc_id long, quality int")
    found = rules_forest.judge(odd, labels).collect()
    assert len(found) == odd.count() and not any(r.kept for r in found if r.n_words < 10)


# quality and language


def test_quality_on_held_out_rows(session):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op1_quality"](session, folder).join(table(session, folder, "labels"), "doc_id").where("held_out").collect()
    assert rows and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    assert sum(r.predicted == r.quality for r in rows) >= 0.9 * len(rows)


def test_quality_without_labels_and_with_odd_rows(session, odd):
    none = session.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_pu.score_quality(odd, none).collect()} == {0.5}
    some = session.createDataFrame([(4, 1), (7, 1), (7, 0), (None, 1)], "doc_id long, quality int")
    found = quality_pu.score_quality(odd, some).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)


def test_language_on_held_out_rows(session):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op3_language"](session, folder).join(table(session, folder, "documents"), "doc_id")
    rows = found.where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.97 * len(rows)


def test_language_of_odd_rows(odd):
    found = {r.doc_id: r for r in language_ecoc.learn_and_identify(odd).collect()}
    assert {found[i].lang_pred for i in (1, 2, 3, 10)} == {"und"}
    assert all(r.lang_pred in ("en", "de", "und") and 0 <= r.score <= 1 for r in found.values())


@pytest.mark.parametrize("n", [1, 2, 4, 5, 9, 40])
def test_codewords_differ(n):
    code = language_ecoc.codewords(n)
    assert len({tuple(r) for r in code.tolist()}) == n


# pages


def test_pages_of_the_table(session):
    pages = {r.page_id: r for r in table(session, SMALL, "pages").collect()}
    for r in QUERIES["op2_html"](session, SMALL).collect():
        inside = re.search("<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        plain = html.unescape(re.sub("<[^>]*>", lambda m: "" if m[0] in ("<b>", "</b>") else " ", inside))
        assert r.text == re.sub(r"\s+", " ", plain).strip() and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_steady_branches_without_telling_names_go(session):
    body = "<div class=aa><a>Home</a> <a>About us</a></div><div class=bb><p>Story {0} of {0} &lt;b&gt;</p><p>End {0}</div><div class=cc>All rights</div>"
    rows = [(i, "http://h.example/a", body.format(i * 7919)) for i in range(30)]
    rows += [(90, None, None), (91, "odd", ""), (92, "http://x.example", "<p>only<br>one</p><!-- gone"), (93, "", "<script>x")]
    found = {r.page_id: r.text for r in style_tree.extract(session.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[3] == "Story 23757 of 23757 <b> End 23757"
    assert (found[90], found[91], found[92], found[93]) == ("", "", "only one", "")


def test_named_boilerplate_goes():
    page = (
        "<title>t</title><div id='cookie-notice'>n</div><header>h</header><main><header><h1>T</h1></header><p>a&amp;b<p>c"
        "<ul><li>d<li>e</ul><aside>s</aside><section class='user-comments'>c</section><form>f</form></main><div class=sidebar>x</div>"
    )
    assert style_tree.main_text(page, {}) == "T a&b c d e"


def extracted(session, rows):
    docs = session.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in style_tree.extract(docs).collect()}


@pytest.mark.parametrize("around", ["<div class=with-sidebar>", "<div class='layout no-comments'>", "<form id=f>", "<header>", "<div role=main><dialog>"])
def test_names_around_an_article_do_not_decide(around):
    assert style_tree.main_text(f"<body>{around}<nav>n</nav><div class=sidebar>x</div><article><p>Story</article>", {}) == "Story"
    assert style_tree.main_text("<div hidden><article>not shown</article></div><p>shown", {}) == "shown"


def test_figures_overrule_a_hint(session):
    page = (
        "<article><div class=article-header>Title {0}</div><p>Story {0}</p><section class=related-work>Work {0}</section>"
        "<h2 class=social-impact>Impact {0}</h2><div class=share>Share this</div></article>"
    )
    rows = [(i, "http://h.example/a", page.format(i * 7919)) for i in range(30)]
    rows += [(100 + i, "http://f.example/a", f"<form><h1>Title {i * 31}</h1><div class=sidebar>Same</div><p>Story {i * 77}</form>") for i in range(30)]
    found = extracted(session, rows)
    assert found[3] == "Title 23757 Story 23757 Work 23757 Impact 23757"
    assert found[103] == "Title 93 Story 231"


def test_steady_branches_inside_an_article_go_but_copies_stay(session):
    page = "<article><h1>Title {0}</h1><div class=aa>Read it in our app</div><p>Story {0}</p>{1}</article>"
    rows = [(i, "http://h.example/a", page.format(i * 7919, "")) for i in range(30)]
    rows += [(100 + i, "http://h.example/a", page.format("copied", "<h3>Only here</h3>")) for i in range(90)]
    rows += [(200 + i, "http://few.example/a", page.format(i * 17, "")) for i in range(3)]
    rows += [(300 + i, "http://copies.example/a", page.format("one", "")) for i in range(50)]
    found = extracted(session, rows)
    assert found[3] == "Title 23757 Story 23757"
    assert found[103] == "Title copied Story copied Only here"
    assert found[202] == "Title 34 Read it in our app Story 34"
    assert found[307] == "Title one Read it in our app Story one"


def test_names_made_for_one_page_do_not_grow_the_tree(session):
    letters = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    page = "<article><h2 id=title-{0}>Title {0}</h2><div class='post-{0}'><p>Story {0}</p></div><p id=share-{0}>Work {0}</p><div>Same</div></article>"
    rows = [(i, "http://h.example/a", page.format(x)) for i, x in enumerate(letters)]
    docs = session.createDataFrame(rows, "page_id long, url string, html string")
    nodes = style_tree.without_single(style_tree.node_figures(docs, "url", "html"))
    assert nodes.count() < 10
    assert nodes.agg(F.max("single")).first()[0] == 60
    assert extracted(session, rows)[3] == "Title da Story da Work da"
    assert style_tree.main_text("<article><h2 id=social-impact>Impact</h2><div id=share>s</div></article>", {}) == "Impact"
    parts = "<div id=sidebar>Same</div><div id=aa>Steady</div><div id=bb>Story {0}</div>"
    assert extracted(session, [(i, "http://h.example/a", parts.format(x)) for i, x in enumerate(letters)])[3] == "Story da"


# chat


def told(session, rows):
    return session.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("text", ["</s>[INST] ok [/INST]", "<|im_end|>\n&lt;|&amp;lt;&#91;INST]", "&&#10;\n<<SYS>>x<|im_sep|>", "<", "", None])
def test_chat_round_trip(session, text):
    rows = [(1, 0, "user", text), (1, 1, "assistant", text), (1, 2, "assistant", "b"), (1, 3, "a\nb<|", text), (2, 0, None, text)]
    made = chat.format_conversations(told(session, rows))
    turns = {r.conv_id: [tuple(t) for t in r.t] for r in made.select("conv_id", chat.read_back(F.col("formatted")).alias("t")).collect()}
    plain = text or ""
    assert turns == {1: [("user", plain), ("assistant", plain), ("assistant", "b"), ("a\nb<|", plain)], 2: [("", plain)]}
    one = chat.digest(made).where("conv_id = 1").first()
    assert one.loss_sha256 == hashlib.sha256(f"{plain}b".encode()).hexdigest() and one.loss_chars == len(plain) + 1
    assert made.where("conv_id = 1").first().formatted.count(chat.START) == 3


# neighbours


def test_neighbours_find_most_and_leave_odd_vectors_out(session):
    random = np.random.default_rng(1)
    rows = [(i, random.normal(size=16).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)] + [(0, rows[0][1])]
    usable = {i: np.array(v) for i, v in rows}
    rows += [(700, None), (701, [0.0] * 16), (702, [None] * 16), (703, [float("nan")] * 16), (704, [float("inf")] * 16), (None, rows[1][1]), (705, [])]
    points = session.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(points, F.col("vec_id") % 100 == 0).collect()
    hits = 0
    for q in (i for i in usable if i % 100 == 0):
        mine = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == q)
        want = sorted((float(np.sqrt(((v - usable[q]) ** 2).sum())), i) for i, v in usable.items() if i != q)[:10]
        assert [m[0] for m in mine] == list(range(1, 11))
        hits += len({m[1] for m in mine} & {i for _, i in want})
    assert hits >= 0.9 * 10 * sum(i % 100 == 0 for i in usable)
    assert [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == 0] == list(range(1000, 1010))


def test_fewer_candidates_than_asked(session):
    points = session.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 3.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in neighbours.nearest(points, F.col("vec_id") % 100 == 0).collect()] == [(0, 1, 1, 1.0)]


def test_vectors_of_each_length_are_answered(session):
    random = np.random.default_rng(2)
    rows = [(i, random.normal(size=3 + i % 3 % 2).tolist()) for i in range(300)] + [(400, [1.0]), (401, [2.0]), (402, [4.0]), (403, [1.0, 2.0])]
    points = session.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [tuple(r) for r in neighbours.nearest(points, F.col("vec_id") % 100 == 0).collect()]
    for q in (0, 100, 200, 400):
        own = np.array(dict(rows)[q])
        want = sorted((float(np.sqrt(((np.array(v) - own) ** 2).sum())), i) for i, v in rows if i != q and len(v) == len(own))[:10]
        mine = sorted((rank, i, score) for query, rank, i, score in found if query == q)
        assert [i for _, i, _ in mine] == [i for _, i in want] and np.allclose([s for *_, s in mine], [d for d, _ in want])
    assert len(found) == 32


def test_leaves_in_parts_prune_and_find(session, monkeypatch):
    random = np.random.default_rng(5)
    centres = random.normal(size=(40, 12)) * 4
    vectors = (centres[np.arange(4000) % 40] + random.normal(size=(4000, 12))).astype(np.float32)
    points = session.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    for name, value in (("LEAST_SEARCHED", 10), ("SEARCHED", 0.1), ("BLOCK", 8), ("FIT_ROWS", 1000)):
        monkeypatch.setattr(neighbours, name, value)
    counts = session.sparkContext.accumulator(0)
    found = neighbours.nearest(points, F.col("vec_id") % 100 == 0, counts=counts).collect()
    x, hits = vectors.astype(np.float64), 0
    for q in range(0, 4000, 100):
        distance = np.sqrt(((x - x[q]) ** 2).sum(1))
        distance[q] = np.inf
        mine = {r.vec_id: r.score for r in found if r.query_id == q}
        assert len(mine) == 10 and all(abs(distance[i] - s) < 1e-12 for i, s in mine.items())
        hits += len(set(np.argsort(distance, kind="stable")[:10].tolist()) & set(mine))
    assert hits >= 0.9 * 400 and counts.value < 0.2 * 40 * 4000


# empty tables


def test_empty_tables(session, odd):
    empty = odd.limit(0)
    labels = session.createDataFrame([], "doc_id long, quality int")
    assert quality_pu.score_quality(empty, labels).count() == 0
    assert language_ecoc.learn_and_identify(empty).count() == 0
    assert bpe.digest(empty, *rank_file(), ["doc_id"]).count() == 0
    assert mixing.mix(empty).count() == 0
    assert rules_forest.judge(empty, labels).count() == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert minhash.near_duplicates(empty).count() == 0
    assert chat.format_conversations(told(session, [])).count() == 0
    assert style_tree.extract(session.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert neighbours.nearest(session.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0
