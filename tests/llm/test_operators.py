"""The operators against brute force, round trips and held-out accuracy, on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

import public_tokenizers
from barline.llm import chat, decontaminate, fingerprint, language, linededup, neardup, packing, pii, toxicity, warc
from barline.llm.components import components
from barline.llm.tables import remainder
from barline.session import fresh_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, label string, keep string"


def documents(spark, texts, lang="en"):
    """A documents table with columns whose names operators use themselves."""
    rows = [(i, t, lang, "s", len(t or ""), "x", "y", "z") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(300)]
    return [rng.choice(words) for _ in range(n)]


def edited(words, seed, n):
    rng, out = random.Random(seed), list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"new{seed}x{i}"
    return out


def weighted_jaccard(a, b, k=5):
    bags = []
    for t in (a, b):
        w = re.findall(r"[a-z0-9]+", t.lower())
        bags.append(Counter(tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1 if w else 0))))
    total = sum((bags[0] | bags[1]).values())
    return sum((bags[0] & bags[1]).values()) / total if total else 0.0


ODD = [None, "", " ", "word", "?!", "word word word word word word word", "a\n\nb", "é" * 30, "\U0001f600 \\ <|x|>"]


# --- 1 near duplicates ---------------------------------------------------------------


def test_near_duplicates_match_brute_force(spark):
    base = [" ".join(prose(s, 200)) for s in range(6)]
    near = [" ".join(edited(base[s % 3].split(), s, 1 + s % 4)) for s in range(12)]
    hot = [base[5]] * 40
    texts = ODD + base + near + hot + [base[0] + " " + " ".join(prose(99, 300))]
    got = {r.doc_id: r for r in neardup.classes(documents(spark, texts)).collect()}
    assert len(got) == len(texts)
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if texts[i] and texts[j] and weighted_jaccard(texts[i], texts[j]) >= 0.8:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    assert {i: r.class_id for i, r in got.items()} == {i: root(i) for i in range(len(texts))}
    assert {i for i, r in got.items() if r.keep} == {i for i in range(len(texts)) if root(i) == i}


def test_texts_of_one_template_keep_their_links(spark):
    """Pairs just below and above the threshold: most leaders refuse most texts."""
    base = prose(5, 300)
    texts = [" ".join(edited(base, s, 4 + s % 5)) for s in range(400)]
    bags = [frozenset(zip(*(t.split()[i:] for i in range(5)), strict=False)) for t in texts]
    assert {len(b) for b in bags} == {296}  # no shingle repeats
    pairs = [(i, j) for i in range(len(bags)) for j in range(i) if 10 * len(bags[i] & bags[j]) >= 8 * len(bags[i] | bags[j])]
    found = {r.doc_id: r.class_id for r in neardup.classes(documents(spark, texts)).collect()}
    assert len(pairs) > 200
    assert sum(found[i] == found[j] for i, j in pairs) >= 0.9 * len(pairs)
    linked = {i for pair in pairs for i in pair}
    assert all(found[i] == i for i in range(len(texts)) if i not in linked)


def test_links_of_near_copies_grow_with_the_texts(spark, monkeypatch):
    """Each copy is like dozens of leaders, so the pairs are many times the texts."""
    base, seen = prose(6, 300), []
    texts = [" ".join(edited(base, s, 1 + s % 3)) for s in range(200)]

    def counted(links):
        seen.append(links.count())
        return components(links)

    monkeypatch.setattr(neardup, "components", counted)
    assert {r.class_id for r in neardup.classes(documents(spark, texts)).collect()} == {0}
    assert seen[0] < 3 * len(texts)


def test_fewer_links_hold_the_same_together(spark):
    import random

    rng = random.Random(3)
    pairs = [(i, j) for i in range(300) for j in rng.sample(range(40 * (i // 100), 40 * (i // 100) + 40), rng.randint(1, 9)) if i != j]
    pairs += [(i, i + 1) for i in range(400, 450)] + [(i + 1, i) for i in range(460, 480)]
    label = lambda links: sorted((r.node, r.label) for r in components(links).collect())
    fewer = neardup.spanning(spark.createDataFrame(pairs, "node long, leader long"))
    assert label(fewer) == label(spark.createDataFrame(pairs, "a long, b long"))


def test_signatures_estimate_weighted_similarity_without_bias():
    import numpy as np
    import pyarrow as pa

    from barline.llm.words import word_hashes

    a = " ".join(["x", "y", "z"] * 10 + prose(1, 60))
    b = " ".join(["x", "y", "z"] * 25 + prose(1, 60))
    words, starts = word_hashes(pa.array([a, b], pa.large_string()))
    signed = neardup.signatures(words, starts, m=6000)
    assert abs((signed[0] == signed[1]).mean() - weighted_jaccard(a, b)) < 0.03
    assert np.isfinite(signed).all()


def test_repeated_rows_keep_one(spark):
    docs = documents(spark, ["one two three four five six"]).union(documents(spark, ["one two three four five six"]))
    assert neardup.drop_near_duplicates(docs).count() == 1


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101)], "a long, b long")
    got = {r.node: r.label for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100}


# --- 2 fingerprints -------------------------------------------------------------------


def test_fingerprints_follow_the_edit_rule(spark):
    texts = [*ODD, " ".join(prose(3, 500)), "hot " * 300, "emoji \U0001f600\U0001f600 text"]
    got = {r.doc_id: r for r in fingerprint.fingerprints(documents(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        own, following = t or "", (texts[i - 1] if i else texts[-1]) or ""
        half = len(own) // 2
        want = own[: len(own) - half] + following[:half]
        assert got[i].edited_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert got[i].n_chars == len(own)
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert got[0].fingerprint == got[1].fingerprint  # a null is an empty text


def test_fingerprints_see_order_and_small_edits(spark):
    words = prose(5, 400)
    texts = [" ".join(words), " ".join(edited(words, 1, 4)), " ".join(words[200:] + words[:200]), " ".join(prose(6, 400))]
    rows = fingerprint.fingerprinted(documents(spark, texts).select("doc_id", "text"), "text", "fp")
    pairs = rows.alias("a").crossJoin(rows.withColumnsRenamed({"doc_id": "other", "fp": "fq"}).select("other", "fq"))
    like = {(r.doc_id, r.other): r.x for r in pairs.select("doc_id", "other", fingerprint.likeness("fp", "fq").alias("x")).collect()}
    assert like[0, 0] == 1 and like[0, 1] > 0.7 and like[0, 3] < 0.1
    assert like[0, 2] < like[0, 1]


def test_fingerprints_of_repeated_ids_and_missing_ones(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "e f g h"), (None, "x y"), (7, None)], "doc_id long, text string")
    got = fingerprint.fingerprints(docs).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "7", "None"]


# --- 3 decontamination ------------------------------------------------------------------


def test_blocks_of_a_pass_take_no_more_jobs_than_one(spark, monkeypatch):
    """The driver's memory held what each block's products gathered, one job after the other."""
    items = [" ".join(prose(s, 36)) for s in range(16)]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = documents(spark, [" ".join(prose(s, 90)) for s in range(100, 110)] + [items[3], items[12]])

    def passes(block):
        monkeypatch.setattr(decontaminate, "BLOCK", block)
        spark.sparkContext.setJobGroup(f"blocks-{block}", "")
        found = list(decontaminate.models(docs, benchmark))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"blocks-{block}"))

    (one, jobs), (eight, more) = passes(16), passes(4)
    assert [len(x) for x in one] == [1] and len(eight) == 1 and len(eight[0]) > 4
    assert more <= jobs + 2
    assert sorted(i for m in eight[0] for i in m["owners"]) == sorted(one[0][0]["owners"])
    monkeypatch.setattr(decontaminate, "BLOCK", 4)
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark).collect()} == {(10, 3), (11, 12)}


def test_latent_space_keeps_the_passages():
    import numpy as np

    rng = np.random.default_rng(4)
    row, term = np.repeat(np.arange(30), 20), np.concatenate([rng.choice(500, 20, replace=False) for _ in range(30)])
    weight = np.full(len(row), 20**-0.5)
    terms, v = decontaminate.latent_space(row, term, weight)
    a = np.zeros((30, len(terms)))
    a[row, np.searchsorted(terms, term)] = weight
    assert np.abs(v.T @ v - np.eye(v.shape[1])).max() < 1e-4
    assert np.linalg.norm(a - a @ v @ v.T) ** 2 <= 0.0011 * np.linalg.norm(a) ** 2


def test_leaks_are_found_and_clean_texts_left(spark):
    items = [" ".join(prose(s, 30 + s)) + ". Because " + " ".join(prose(s + 50, 6)) + "." for s in range(8)]
    benchmark = spark.createDataFrame([*enumerate(items), (90, None), (91, "")], "item_id long, text string")
    clean = [" ".join(prose(s, 150)) for s in range(100, 120)]
    clean.append(" ".join(clean[0].split()[:60]) + " " + " ".join(items[0].split()[:8]))  # a shared phrase only
    verbatim = [" ".join(prose(200 + s, 70)) + " " + x + " " + " ".join(prose(300 + s, 50)) for s, x in enumerate(items)]
    words = items[2].split()
    paraphrase = " ".join(w if i % 4 or i > 30 else f"other{i}" for i, w in enumerate(words))
    texts = [*ODD, *clean, *verbatim, paraphrase]
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(documents(spark, texts), benchmark).collect()}
    first = len(ODD) + len(clean)
    assert got == {(first + i, i) for i in range(8)} | {(len(texts) - 1, 2)}
    kept = decontaminate.drop_leaks(documents(spark, texts), benchmark)
    assert kept.count() == len(texts) - 9 and kept.columns == documents(spark, texts).columns


def test_common_subsequence_matches_the_table():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.common_subsequence(a, b) == table[-1][-1]


def test_a_benchmark_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK", 4)
    items = [" ".join(prose(s, 25)) for s in range(20)]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(documents(spark, items), benchmark).collect()}
    assert got == {(i, i) for i in range(20)}


# --- 4 personal data -----------------------------------------------------------------------


def test_base_spans_match_the_patterns():
    texts = [
        "a@b.c_d@e.f x.y@z.org, 300.1.1.1 10.0.0.1 é 4111 1111-1111 1111 +1 (787) 555-1710 35.92.216.95",
        "4055105915866795 +49 30 1234567. @ a@ @b.c +1-2", "1.2.3.4.5.6.7.8 " + "9" * 30, "",
    ]
    for t in texts:
        want = [
            (n, m.start(), m.end())
            for n, k in enumerate(pii.KINDS)
            for m in re.finditer(pii.PATTERNS[k], t)
            if pii.valid(k, m.group())
        ]
        assert pii.base_spans(t) == want


def test_contexts_discover_unseen_identifiers(spark):
    seeds = [f"please write to user{i}@mail.org now" for i in range(6)]
    hidden = ["please write to user77(at)mail.org now", "it costs 123456 coins here", None, ""]
    got = {r.doc_id: r for r in pii.summary(pii.find(documents(spark, seeds + hidden))).collect()}
    assert got[6].spans == "email:16:34".replace("34", str(16 + len("user77(at)mail.org")))
    assert got[7].spans == "" and got[8].spans == "" and got[6].n_email == 0
    assert got[0].base_sha256 == hashlib.sha256(b"email:16:30").hexdigest() and got[0].n_email == 1
    assert got[8].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_pii_counts_are_by_kind_wherever_a_span_stands(spark):
    texts = ["from 10.0.0.1 and 10.0.0.2 and 10.0.0.3", "call +1 415 555 2671", "a@b.c or d@e.f, 10.0.0.4", "none", None]
    got = {r.doc_id: r for r in pii.summary(pii.find(documents(spark, texts))).collect()}
    for i, t in enumerate(texts):
        spans = sorted(pii.base_spans(t or ""))
        each = Counter(pii.KINDS[k] for k, _, _ in spans)
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [each[k] for k in pii.KINDS]
        listed = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in spans)
        assert got[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()


# --- 5 lines -----------------------------------------------------------------------------------


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1 :] or a[i + 1 :] == b[i + 1 :]


def test_lines_match_brute_force(spark):
    rng = random.Random(9)
    stock = ["".join(rng.choices("abcé ", k=rng.randint(20, 60))).strip().ljust(20, "q") for _ in range(12)]

    def variant(x):
        i, kind = rng.randrange(len(x) + 1), rng.random()
        if kind < 0.3:
            return x
        if kind < 0.5:
            return x[:i] + "z" + x[i:]
        if kind < 0.7:
            return x[:i] + x[i + 1 :]
        return x[:i] + "y" + x[i + 1 :] if kind < 0.9 else x[:i] + "uv" + x[i + 1 :]

    texts = ["\n".join(variant(rng.choice(stock)) for _ in range(rng.randint(1, 6))) for _ in range(60)]
    texts += ODD + [f"this is page {i} of the long book" for i in range(30)] + ["short", "short"]
    got = {r.doc_id: set(r.places) for r in linededup.dropped_lines(documents(spark, texts)).collect()}
    seen, want = [], {}
    for i, t in enumerate(texts):
        for j, line in enumerate((t or "").split("\n")):
            line = line.strip(" ").lower()
            if len(line) < linededup.MIN_CHARS:
                continue
            if any(x == line or within_one(x, line) for x in seen):
                want.setdefault(i, set()).add(j)
            seen.append(line)
    assert got == want
    kept = {r.doc_id: r.text for r in linededup.drop_repeated_lines(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        if i not in want:
            assert kept[i] == t
        else:
            left = "\n".join(x for j, x in enumerate(t.split("\n")) if j not in want[i])
            assert kept.get(i, "") == (left if left.strip() else "")


# --- 6 archives -----------------------------------------------------------------------------------


def test_archives_round_trip_and_partial_reads(spark):
    rows = [(i, f"http://x/{i}", f"<p>{i % 7} é\r\n\r\nWARC/1.1\r\n</p>" * (i % 7)) for i in range(60)]
    rows += [(60, None, None), (61, "http://x/\r\nEvil: 1", ""), (None, "u", "only"), (None, "u", "only")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = fresh_path(spark, "archives")
    index = warc.write_archives(pages, folder)
    got = warc.read_records(index, folder).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got if r.page_id is not None}
    for i, _, html in rows[:62]:
        same = max(j for j, _, h in rows[:62] if (h or "") == (html or ""))
        assert by_id[i].payload_bytes == len((html or "").encode())
        assert by_id[i].payload_digest == warc.base32_sha1((html or "").encode())
        assert (by_id[i].record_type, by_id[i].refers_to) == (("response", None) if same == i else ("revisit", same))
    some = warc.read_records(index.filter("page_id in (5, 40)"), folder).collect()
    assert sorted(r.page_id for r in some) == [5, 40]
    assert warc.archived(pages.limit(0)).count() == 0


# --- 7 languages ------------------------------------------------------------------------------------


def test_languages_on_held_out_and_code_switched_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fitted(docs, remainder(3) != 1)
    named = docs.select("lang", language.labelled(docs, model).alias("f"), remainder(3).alias("r")).filter("r = 1")
    hits = [r.lang == r.f.lang for r in named.collect()]
    assert sum(hits) / len(hits) >= 0.97
    odd = documents(spark, ODD).select("doc_id", language.labelled(documents(spark, ODD), model).alias("f"))
    assert [r.f.lang == "und" for r in odd.orderBy("doc_id").collect()] == [True, True, True, False, True, False, False, False, False]
    import pyarrow as pa

    two = {r.lang: r.text for r in docs.filter("length(text) > 600").collect()}
    share, sizes = language.shares(language.read(pa.array([two["en"][:600] + " " + two["de"][:600]], pa.large_string())), model)
    mixed = share[0] / sizes[0]
    assert mixed[model.languages.index("en")] > 0.3 and mixed[model.languages.index("de")] > 0.3


def test_unknown_languages_go_and_known_ones_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(1)
    odd = [
        " ".join(f"{rng.getrandbits(128):032x}" for _ in range(30)),
        " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(100)),
        "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。" * 5,
        "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему. " * 4,
    ]
    more = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(odd)], docs.schema)
    usable = remainder(3) != 1
    kept = {r.doc_id for r in language.keep_known(docs.union(more), usable).select("doc_id").collect()}
    assert not [i for i in kept if i < 0]
    held_out = [r.doc_id for r in docs.filter(~usable).collect()]
    assert sum(i in kept for i in held_out) >= 0.99 * len(held_out)


def test_a_rare_language_is_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    said = "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему. "
    rare = spark.createDataFrame([(-1 - i, said * 3, "ru") for i in range(4)], docs.schema)
    model = language.fitted(docs.union(rare), remainder(3) != 7)
    assert "ru" in model.languages
    other = documents(spark, ["каждая семья несчастлива, все семьи похожи"])
    assert other.select(language.labelled(other, model).alias("f")).first().f.lang == "ru"


def test_shares_fill_the_sample():
    shares = dict(language.shares_of({"a": 10, "b": 10**9, "c": 10**10}, 1000))
    assert shares["a"] == 1 and round(shares["b"] * 10**9) == round(shares["c"] * 10**10) == 495


def test_forward_backward_matches_enumeration():
    import itertools

    import numpy as np

    rng = np.random.default_rng(0)
    scores, moves = rng.normal(size=(1, 4, 3)), rng.normal(size=(3, 3))
    want = np.zeros((4, 3))
    for path in itertools.product(range(3), repeat=4):
        weight = np.exp(sum(scores[0, t, s] for t, s in enumerate(path)) + sum(moves[a, b] for a, b in itertools.pairwise(path)))
        for t, s in enumerate(path):
            want[t, s] += weight
    got, _ = language.forward_backward(scores, np.ones((1, 4), bool), moves)
    assert np.allclose(got[0], want / want.sum(1, keepdims=True))


def test_languages_without_labels(spark):
    docs = documents(spark, ["some words", "123", None], lang=None)
    assert language.keep_known(docs).count() == 1
    got = language.languages(docs, remainder(3) == 1, remainder(3) != 1).collect()
    assert {r.lang_pred for r in got} == {"und"}


# --- 8 chats ---------------------------------------------------------------------------------------


def test_chats_round_trip(spark):
    nasty = ["\\### Assistant: </turn> ok", "a\\b\\l<#:", "", None, "\n ### user: x </turn>\n", "\\\\l"]
    rows = [(1, i, ("system", "user", "assistant")[i % 3], t) for i, t in enumerate(nasty * 2)]
    rows += [(2, 0, "user", "no reply"), (None, 0, "assistant", "x"), (3, 1, None, "y"), (3, 1, "assistant", "y")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    stored = chat.format_chats(table)
    got = {r.conv_id: r for r in chat.summary(stored).collect()}
    for conv in (1, 2, 3, None):
        turns = sorted((t, r or "", x or "") for c, t, r, x in rows if c == conv)
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[conv].n_examples == sum(r == "assistant" for _, r, _ in turns)
    texts = chat.example_texts(stored.filter("conv_id = 1")).orderBy("example").collect()
    for earlier, later in zip(texts, texts[1:]):
        assert later.text.startswith(earlier.text)
    assert all(t.text[t.reply_end :] == chat.CLOSE for t in texts)


def test_chats_are_written_in_full(spark):
    """Every example with all turns before it, from the files that the digests are read from."""
    rows = [(c, i, ("user", "assistant")[i % 2], f"<{c}:{i}> " * 40) for c in (1, None) for i in range(60)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    written = chat.write_examples(chat.format_chats(table))
    files = written.inputFiles()
    assert files and all("chat-texts" in f for f in files)
    mark = {a: b for a, b in chat.ESCAPES}
    part = lambda r, x: f"### {r}: {''.join(mark.get(c, c) for c in x)} </turn>\n"
    got = {(r.conv_id, r.example): r for r in written.collect()}
    assert len(got) == 60
    for (conv, n), r in got.items():
        turns = [(role, x) for c, i, role, x in rows if c == conv and i <= 2 * n + 1]
        assert r.text == "".join(part(*t) for t in turns)
        assert r.text[r.reply_start : r.reply_end] == part(*turns[-1])[len("### assistant: ") : -len(chat.CLOSE)]
    plan = chat.summary(chat.format_chats(table))
    assert any("chat-texts" in f for f in plan.inputFiles())


# --- 9 packing ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("shard_rows", [5, 2048])
def test_packing_holds_every_id_once(spark, shard_rows):
    import numpy as np
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing_tokenizer := "word_bpe_49k.json")
    assert packing_tokenizer
    texts = ODD + [" ".join(prose(s, 40 * s)) for s in range(1, 30)] + ["It's 12,5 <|endoftext|> x　y ÀÉ Σας İ don't. ßöÿ÷ø. e\u0301té Été, naïve... a.b,c. \u0301x  ."] + ["same text"] * 20
    docs = documents(spark, texts)
    rows = packing.packed(docs, path, shard_rows).toPandas()
    encode = Tokenizer.from_file(path)
    for i, t in enumerate(texts):
        ids = np.array(encode.encode(t or "", add_special_tokens=False).ids + [2], np.uint32)
        mine = rows[rows.doc_id == i].sort_values("start")
        at = 0
        for r in mine.itertuples():
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].astype("<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for _, group in rows.sort_values("offset").groupby("sequence_id"):
        assert group.offset.tolist() == [0, *np.cumsum(group.length)[:-1]] and group.length.sum() <= 4096
    full = (rows.groupby("sequence_id").length.sum() == 4096).sum()
    assert rows.sequence_id.nunique() - full <= -(-len(texts) // shard_rows) + 1


PACKING_MEMORY = """
import random, sys
import numpy as np, pandas, pyarrow as pa
from barline.llm import packing

def kilobytes(key):
    return next(int(x.split()[1]) for x in open("/proc/self/status") if x.startswith(key))

rng = random.Random(5)
letters = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8))
words = [letters() for _ in range(20_000)]
cut = packing.cutter(sys.argv[1])
schema = pa.schema([("doc_id", pa.int64()), ("shard", pa.int64()), ("text", pa.string())])

def batches(n, rows, fresh):
    for _ in range(n):
        texts = [" ".join([letters() for _ in range(fresh)] + rng.choices(words, k=300 - fresh)) for _ in range(rows)]
        yield pa.record_batch([pa.array([1] * rows), pa.array([0] * rows), pa.array(texts)], schema=schema)

def whole(batches):
    return sum(int(out.column("doc_tokens").to_numpy().sum()) > 0 for out in cut(batches))

assert whole(batches(1, 10, 0))
before = kilobytes("VmRSS")
assert whole(batches(6, 4_000, 25))
print((kilobytes("VmHWM") - before) // 1024)
"""


def test_packing_holds_little_beside_a_batch():
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = public_tokenizers.path("word_bpe_49k.json")
    env = os.environ | {"PYTHONPATH": os.pathsep.join([root, *sys.path])}
    run = subprocess.run([sys.executable, "-c", PACKING_MEMORY, path], env=env, capture_output=True, text=True, check=True)
    assert int(run.stdout) < 150, run.stdout  # batches of 11 MB, 600,000 words met once


def test_index_prefers_like_documents():
    import numpy as np

    terms = [np.array(x, np.uint32) for x in ([1, 2, 3], [1, 2, 9], [7, 8], [3, 8], [5, 6])]
    index = packing.Index(terms, [np.ones(len(t), np.uint16) for t in terms])
    scores = index.like(0)
    assert scores[1] > scores[3] > scores[2] == 0


def test_packing_makes_no_calls_for_every_word():
    """Words are looked up, and new ones encoded, many at a time: that takes most of the CPU."""
    import sys

    import pyarrow as pa

    words = [f"{a}{b}{c}" for a in prose(1, 40) for b in prose(2, 40) for c in ("é", "X", "%%%", "ing", "ÉES!")]
    texts = [" ".join(random.Random(i).choices(words, k=400)) for i in range(100)]
    batch = pa.record_batch([pa.array([1] * 100), pa.array([0] * 100), pa.array(texts)], ["doc_id", "shard", "text"])
    cut, calls = packing.cutter(public_tokenizers.path("word_bpe_49k.json")), []
    list(cut([batch.slice(0, 1)]))
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event in ("call", "c_call") else None)
    try:
        list(cut([batch]))
    finally:
        sys.setprofile(None)
    assert len(calls) < len(set(words)), (len(calls), len(set(words)))


def test_packing_keeps_repeated_words_of_a_full_vocabulary(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    encode = Tokenizer.from_file(path)
    odd = "It's rock' x''s Éa!? ÉÀÞ%% ßÿ-÷ ×x a^_`{|}~ x<|endoftext|>. <|endoftext|!! naïve,... Σας! İ. \u0958, \ufb2a. e\u0301!, \t\t a\tb\r. 12! x9."
    often = [w + s for w in set(prose(3, 60)) for s in ("", "é", "É.", "!?,", "ING")] + odd.split(" ")
    rng = random.Random(4)
    texts = [" ".join(rng.choices(often, k=60) + [f"{rng.random()}x{i}"] * (i % 3)) for i in range(400)]
    monkeypatch.setattr(packing, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(packing, "CACHED_BYTES", 8000)
    monkeypatch.setattr(packing, "WORDS", 100)
    monkeypatch.setattr(packing, "JOINED", 7)
    packing.shared_vocabulary.cache_clear()
    sizes, thin = [], packing.Vocabulary.thin
    monkeypatch.setattr(packing.Vocabulary, "thin", lambda v: (sizes.append(len(v.parts)), thin(v), sizes.append(len(v.parts))))
    ids = []
    for part in packing.chunks(pa.array(texts), packing.CHUNK_BYTES):
        vocabulary = packing.shared_vocabulary(path)
        if vocabulary.room() > packing.CACHED_BYTES:
            vocabulary.thin()
        ids += [x.tolist() for x, _, _ in packing.tokenized(part, vocabulary)]
    packing.shared_vocabulary.cache_clear()
    assert ids == [encode.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert any(1 < after < before for before, after in zip(sizes[::2], sizes[1::2], strict=True))


def test_packing_shrinks_its_index_without_effect(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(6)
    terms = [np.unique(rng.zipf(1.3, 80) % 500).astype(np.uint32) for _ in range(300)]
    counts = [rng.integers(1, 5, len(t)).astype(np.uint16) for t in terms]
    sizes = rng.integers(1, 4096, 300).tolist()
    found, kept = [], []
    keep = packing.Index.keep
    monkeypatch.setattr(packing.Index, "keep", lambda index, left: (keep(index, left), kept.append(len(index.owner))))
    for share in (0.0, 0.8, 1.0):
        monkeypatch.setattr(packing, "FORGET", share)
        found.append(list(packing.fill(sizes, packing.Index(terms, counts))))
    assert found[0] == found[1] == found[2] and kept
    assert all(sum(high - low for _, low, high in took) == 4096 for took in found[0][:-1])


# --- 10 toxicity ----------------------------------------------------------------------------------------


def test_toxicity_is_learned_and_tolerates_inserted_characters(spark):
    rng, rows, labels = random.Random(2), [], []
    for i in range(400):
        words = prose(rng.randint(0, 9), 60)
        if i % 3 == 0:
            words[rng.randrange(60)] = rng.choice(["wretched", "scoundrel", "numbskull"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    for i, word in enumerate(["wret-ched", "scoun.drel", "numbbskull", "wrettched"]):
        rows.append((1000 + i, " ".join([*prose(3, 30), word, *prose(4, 20)])))
    rows += [(2000, None), (2001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.scored(docs, marks, remainder(5) == 0, remainder(5) != 0).collect()}
    held = [(got[i].predicted, t) for i, t in labels if got[i].held_out]
    assert sum(p == t for p, t in held) / len(held) > 0.95
    clean = max(got[i].score for i, t in labels if not t and got[i].held_out)
    assert all(got[1000 + i].score > max(clean, 0.4) for i in range(4))
    assert got[2000].predicted == got[2001].predicted == 0 and all(0 <= r.score <= 1 for r in got.values())
    none = toxicity.scored(docs, marks.limit(0), remainder(5) == 0, remainder(5) != 0)
    assert {r.score for r in none.collect()} == {0.0}


def test_columns_named_like_our_own_are_left_alone(spark):
    """The names that earlier versions used inside, with equal values in every row."""
    texts = [" ".join(prose(s, 60)) + "\n" + " ".join(prose(100 + s, 30)) for s in range(8)]
    docs = documents(spark, [*texts, texts[0], texts[3]])
    for name in ("_llm_row", "_llm_places", "_llm_lang", "place", "bands"):
        docs = docs.withColumn(name, docs.doc_id * 0)
    for drop, left in ((linededup.drop_repeated_lines, 8), (neardup.drop_near_duplicates, 8), (language.keep_known, 10)):
        kept = drop(docs)
        assert kept.columns == docs.columns and kept.count() == left
        assert kept.filter("_llm_row <> 0 or _llm_places <> 0 or _llm_lang <> 0").count() == 0


def test_many_blocks_are_searched_in_one_pass(spark, monkeypatch):
    """A benchmark of several blocks, and of several passes, gives the items of one."""
    items = [" ".join(prose(1000 + i, 45)) for i in range(40)]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [" ".join(prose(7, 80)) + " " + items[i % 40] + " " + " ".join(prose(8, 50)) for i in range(0, 90, 3)] + ODD
    want = {(d, i % 40) for d, i in enumerate(range(0, 90, 3))}
    for block, blocks in ((256, 8), (8, 8), (8, 2)):
        monkeypatch.setattr(decontaminate, "BLOCK", block)
        monkeypatch.setattr(decontaminate, "BLOCKS_A_PASS", blocks)
        found = decontaminate.leaks(documents(spark, texts), benchmark)
        assert sorted((r.doc_id, r.item_id) for r in found.collect()) == sorted(want)
