from collections import defaultdict

from pyspark.sql import functions as F

from cvelake.llm import preferences
from cvelake.llm.queries import QUERIES
from helpers_llm import SF


def render(turns):
    return "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)


def mask(turns):
    out, at = [], 0
    for r, t in turns:
        start = at + len(f"<|{r}|>\n")
        if r == "assistant" and t:
            out.append((start, start + len(t)))
        at = start + len(t) + len("<|end|>\n")
    return out


def formatted(chosen, rejected):
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    return n, render(chosen[:n]), render(chosen[n:]), render(rejected[n:]), mask(chosen[n:]), mask(rejected[n:])


def test_pairs_match_a_plain_version(spark):
    u, a, b = ("user", "hi 𝒳"), ("assistant", "good"), ("assistant", "bad")
    pairs = [
        (1, [u, a], [u, b]), (2, [u, a], [u, a]), (3, [u, a, u, b], [u, a]), (4, [], [u]), (5, None, [u, b]), (6, [u, a], None),
        (7, [("system", "s"), u, a], [u, a]), (8, [u, ("assistant", "")], [u, b]), (9, [u, ("user", "good")], [u, a]), (9, [u, a], [u, b]),
    ]
    turns = lambda x: None if x is None else [(i, *t) for i, t in enumerate(x)]
    schema = "pair_id long, chosen array<struct<turn:long,role:string,text:string>>, rejected array<struct<turn:long,role:string,text:string>>"
    df = spark.createDataFrame([(i, turns(c), turns(r)) for i, c, r in pairs], schema).withColumn("prompt", F.lit("x"))
    got = sorted((r["pair_id"], r["n_prompt"], r["prompt"], r["chosen"], r["rejected"], [tuple(s) for s in r["chosen_mask"]], [tuple(s) for s in r["rejected_mask"]]) for r in preferences.format_pairs(df).collect())
    assert got == sorted((i, *formatted(c or [], r or [])) for i, c, r in pairs)


def sibling_pairs(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    last = lambda v: max((i for i, t in enumerate(v) if t[0] == "assistant"), default=-1)
    for c, v in convs.items():
        if last(v) >= 0:
            other = convs.get(c ^ 1, [])
            reply = [other[last(other)]] if last(other) >= 0 else []
            yield c, v, v[: last(v)] + reply


def test_query_on_all_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    text = lambda spans: ",".join(f"{a}:{b}" for a, b in spans)
    want = []
    for c, v, rejected in sibling_pairs(rows):
        *plain, chosen_mask, rejected_mask = formatted(v, rejected)
        want.append((c, *plain, text(chosen_mask), text(rejected_mask)))
    got = QUERIES["op4_preference_pairs"](spark, SF).select("pair_id", "n_prompt", "prompt", "chosen", "rejected", "chosen_mask", "rejected_mask")
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and want


def test_odd_conversations(spark):
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", None), (0, 1, "assistant", None), (1, None, None, "x"), (2, 0, "assistant", "solo"), (None, 0, "assistant", "y"), (5, 0, "user", "only")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    got = {r["pair_id"]: ([tuple(t)[1:] for t in r["chosen"]], [tuple(t)[1:] for t in r["rejected"]]) for r in preferences.sibling_pairs(df).collect()}
    assert got == {c: (v, r) for c, v, r in sibling_pairs(rows)}
    assert preferences.format_pairs(preferences.sibling_pairs(df.filter("false"))).count() == 0


def test_siblings_of_large_and_negative_ids(spark):
    rows = []
    for first in (2**60, 2**53 - 2, -4, 2**62):
        for c in range(first, first + 4):
            rows += [(c, 0, "user", f"q{c // 2}"), (c, 1, "assistant", f"a{c}")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["pair_id"]: ([tuple(t)[1:] for t in r["chosen"]], [tuple(t)[1:] for t in r["rejected"]]) for r in preferences.sibling_pairs(df).collect()}
    assert got == {c: (v, r) for c, v, r in sibling_pairs(rows)}
    assert all(len(r) == 2 for _, r in got.values())


def test_a_conversation_with_a_third_of_all_rows(spark):
    rows = [(2, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(20_000)]
    rows += [(c, i, "assistant" if i % 2 else "user", f"turn {i}") for c in range(3, 10_003) for i in range(4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    made = {r["pair_id"]: r for r in preferences.format_pairs(preferences.sibling_pairs(df)).filter("pair_id in (2, 3)").collect()}
    assert made[2]["n_prompt"] == 19_999 and made[2]["rejected"] == render([("assistant", "turn 3")])
    assert made[3]["n_prompt"] == 3 and made[3]["rejected"] == render([("assistant", "turn 19999")])
