"""What the operators once left out."""

from barline.llm.queries import REGISTRY


def written(spark, tmp_path, texts):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_short_lines_that_repeat_go(spark, tmp_path):
    own = [f"a line of its own, made of words that no other line holds: {'xyzuvw'[i] * 30}" for i in range(6)]
    texts = [f"Menu\n{own[0]}", f"{own[1]}\n\nmenu \n\n-", f"-\n{own[2]}\nmenus", own[3] + "\nx\nx", None, "menu"]
    got = {r.doc_id: r.text for r in REGISTRY["op5_linededup"].run(spark, written(spark, tmp_path, texts)).collect()}
    assert got == {0: texts[0], 1: f"{own[1]}\n\n\n-", 2: f"{own[2]}\nmenus", 3: own[3] + "\nx", 4: None}


def test_grouped_numbers_are_found_whole(spark):
    from barline.llm import pii

    seeds = [f"you can call us on +1 787 555 {1000 + i} today" for i in range(12)]
    hidden = ["(787) 555 1710", "0171 234 567", "0171 2345678"]
    texts = seeds + [f"you can call us on {x} today" for x in hidden] + ["we have 12 345 678 coins here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.summary(pii.find(docs)).collect()}
    assert [got[12 + i] for i in range(3)] == [f"phone:19:{19 + len(x)}" for x in hidden]
    assert got[15] == "" and got[0] == "phone:19:34"


def test_long_chains_of_patterns_are_followed(spark):
    from barline.llm import pii

    known, texts, last = [f"user{i}@mail.org" for i in range(4)], [], []
    for level in "abcdefg":
        new = [f"{level}{j}{level}#99{j}77" for j in range(4)]
        for x, one in zip("pqrs", new, strict=True):
            texts += [f"{level}{x} {x}{level} {v}" for v in [*known, one]]
        known = new
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert all(r.spans.startswith("email:6:") for r in pii.summary(pii.find(docs)).collect())
