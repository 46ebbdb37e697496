import random

from pyspark.sql import functions as F

from cvelake.llm import decontaminate as D
from cvelake.llm.queries import QUERIES
from helpers_llm import SF, doc_rows


def substring_distance(pattern, text):
    """Smallest edit distance to any substring, by dynamic programming."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != c)))
        row = new
    return min(row)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, p in enumerate(a, 1):
        new = [i]
        for j, c in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != c)))
        row = new
    return row[-1]


def edited(rng, text, n):
    s = list(text)
    for _ in range(n):
        at = rng.randrange(len(s))
        rng.choice([lambda: s.__setitem__(at, rng.choice("abcé ")), lambda: s.insert(at, rng.choice("xyz ")), lambda: s.pop(at)])()
    return "".join(s)


def test_myers_matches_dynamic_programming():
    rng = random.Random(3)
    for _ in range(300):
        pattern = "".join(rng.choices("abé ", k=rng.randint(1, 90)))
        text = "".join(rng.choices("abé ", k=rng.randint(0, 60)))
        text = text[:30] + edited(rng, pattern, rng.randint(0, 5)) + text[30:] if rng.random() < 0.6 and len(pattern) > 8 else text
        assert D.nearest(D.masks(pattern), len(pattern), text)[0] == min(len(pattern), substring_distance(pattern, text))


def test_split_has_a_piece_more_than_errors():
    for n, budget in ((30, 0), (30, 1), (100, 7), (226, 18)):
        paths = D.split(0, n, budget)
        assert len(paths) == budget + 1
        leaves = [p[0] for p in paths]
        assert [a for a, _, _ in leaves] == [0, *[b for _, b, _ in leaves[:-1]]] and leaves[-1][1] == n
        assert all(p[-1] == (0, n, budget) for p in paths)


def test_no_occurrence_within_the_budget_is_missed():
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdehiorst", k=rng.randint(1, 6)))
    items = [(i, D.normalize(" ".join(word() for _ in range(rng.randint(5, 30))))) for i in range(20)]
    finder = D.Finder(items)
    for _ in range(150):
        i, text = rng.choice(items)
        noisy = edited(rng, text, rng.randint(0, D.budget_of(text) + 3))
        whole = D.normalize(" ".join(word() for _ in range(9)) + " " + noisy + " " + " ".join(word() for _ in range(9)))
        want = {k: d for k, t in items if (d := substring_distance(t, whole)) <= D.budget_of(t)}
        found = finder.find(whole)
        assert {k: d for k, d, _, _ in found} == want
        for k, d, start, end in found:
            assert distance(dict(items)[k], whole[start:end]) == d


def test_edges_and_passes(spark, monkeypatch):
    passage = "Alpha beta, gamma delta epsilon zeta eta theta iota kappa"
    docs = [(1, None), (2, ""), (3, f"x {passage.upper()}!! y"), (3, f"x {passage.upper()}!! y"), (4, passage.replace("gamma", "gemma")), (5, "alpha beta only"), (None, passage), (6, "word " * 40000 + passage)]
    df = spark.createDataFrame([(*d, "m", 0) for d in docs], "doc_id long, text string, matches string, item_id int")
    bench = [(7, passage), (8, passage), (None, passage), (9, None), (10, ""), (11, "alpha beta only"), (12, "lambda mu nu xi omicron pi rho")]
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    monkeypatch.setattr(D, "BLOCK_CHARS", 60)
    found, name = D.matches(df, benchmark)
    assert name == "matches_" and found.columns == [*df.columns, name]
    got = [(r["doc_id"], sorted((m["item_id"], m["distance"]) for m in r[name])) for r in found.collect()]
    hit = [(7, 0), (8, 0)]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == [(1, []), (2, []), (3, hit), (3, hit), (4, [(7, 1), (8, 1)]), (5, []), (6, hit), (None, hit)]
    assert sorted(r["item_id"] for r in D.left_out(benchmark).collect()) == [10, 11]
    assert D.left_out(benchmark, 3).collect()[0]["item_id"] == 10
    kept = D.drop_contaminated(df, benchmark)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 5]
    assert D.drop_contaminated(df, benchmark.filter("false")).count() == len(docs)
    assert D.drop_contaminated(df.filter(F.lit(False)), benchmark).count() == 0


def test_long_items_without_blanks_are_found(spark):
    items = ["下列哪一个选项正确地描述了光合作用的主要过程和产物", "ข้อใดต่อไปนี้อธิบายการสังเคราะห์ด้วยแสงได้ถูกต้อง", "次のうち光合成について正しい説明はどれですか答えなさい"]
    short = ["光合作用", "united states supreme court"]
    benchmark = spark.createDataFrame(list(enumerate(items + short)), "item_id long, text string")
    texts = [f"前文{t}后文" for t in items] + [items[0].replace("描述", "叙述"), f"{short[0]} {short[1]}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found, name = D.matches(df, benchmark)
    got = {r["doc_id"]: [(m["item_id"], m["distance"]) for m in r[name]] for r in found.collect()}
    assert got == {0: [(0, 0)], 1: [(1, 0)], 2: [(2, 0)], 3: [(0, 1)], 4: []}  # 25 letters allow two edits
    assert [r["doc_id"] for r in D.drop_contaminated(df, benchmark).collect()] == [4]


def test_query_finds_every_exact_passage(spark):
    bench = {r["item_id"]: D.normalize(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op1_pigeonhole_decontamination"](spark, SF).collect()}
    rows = doc_rows(spark)
    assert len(got) == len(rows)
    for d in rows:
        text = D.normalize(d["text"])
        exact = {i for i, t in bench.items() if t in text}
        found = {int(x.split(":")[0]): int(x.split(":")[1]) for x in got[d["doc_id"]]["items"].split(",") if x}
        assert exact == {i for i, n in found.items() if n == 0}
        assert got[d["doc_id"]]["contaminated"] == bool(found)


def test_blocks_change_no_match(spark, monkeypatch):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    once = {r["doc_id"]: r["matches"] for r in D.matches(docs, benchmark)[0].collect()}
    monkeypatch.setattr(D, "BLOCK_CHARS", 700)
    held = []
    find = D._find
    monkeypatch.setattr(D, "_find", lambda items, *rest: held.append(sum(len(t) for _, t in items)) or find(items, *rest))
    assert {r["doc_id"]: r["matches"] for r in D.matches(docs, benchmark)[0].collect()} == once
    assert len(held) > 5 and any(once.values())
    assert max(held) < sum(held) / 2
