import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.llm import chat

TURNS = st.lists(st.tuples(st.text(max_size=12), st.text(alphabet=st.sampled_from("\\#:<>/turn \nab</"), max_size=40)), max_size=6)


@given(TURNS)
def test_round_trip(turns):
    formatted, spans = chat.format_turns(turns, loss_role="assistant")
    assert chat.read_turns(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


@given(TURNS)
def test_marks_never_occur_inside(turns):
    formatted, _ = chat.format_turns(turns)
    assert formatted.count(chat.END) == len(turns)


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def read(spark, rows):
    messages = chat.message_chain(conversations(spark, rows))
    out = chat.read_back(chat.format_trees(messages).join(messages.select("tree", "conv_id").distinct(), "tree"))
    return {r["conv_id"]: r for r in out.collect()}


def test_conversations_against_plain_python(spark):
    rng = random.Random(3)
    texts = ["a", "", None, r"\### Assistant: </turn> ok", "x" * 5000, "é\nü"]
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(texts)) for c in [1, 2, 3, None] for t in range(rng.randint(1, 9))]
    got = read(spark, rows)
    assert set(got) == {1, 2, 3, None}
    for conv, r in got.items():
        mine = [(role or "", text or "") for c, _, role, text in rows if c == conv]
        assert r["n_turns"] == len(mine)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in mine).encode()).hexdigest()
        loss = "".join(b for a, b in mine if a == "assistant")
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r["formatted_chars"] == len(chat.format_turns(mine)[0])


def test_ties_and_empty_table(spark):
    got = read(spark, [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "system", "first")])
    assert got[1]["turns_sha256"] == hashlib.sha256(b"system\nfirst\nuser\na\nuser\na\nuser\nb\n").hexdigest()
    assert read(spark, []) == {}


def test_paths_of_branching_trees_against_recursion(spark):
    rng = random.Random(11)
    tree, rows = {}, []
    for name in ("a", "b"):
        parents = {1: None}
        for node in range(2, 40):
            parents[node] = rng.randint(max(1, node - 4), node - 1)
        scores = {n: float(rng.randint(-3, 5)) for n in parents}
        tree[name] = parents, scores
        rows += [(name, n, p, scores[n]) for n, p in parents.items()]
    messages = spark.createDataFrame(rows, "tree string, node long, parent long, score double")
    found = {}
    for r in chat.chosen_paths(messages, branches=2).collect():
        found.setdefault((r["tree"], r["rank"]), []).append((r["depth"], r["node"]))
    for name, (parents, scores) in tree.items():
        paths = []
        for leaf in set(parents) - set(parents.values()):
            path, at = [], leaf
            while at:
                path.insert(0, at)
                at = parents[at]
            paths.append((-sum(scores[n] for n in path), leaf, path))
        for rank, (_, _, path) in enumerate(sorted(paths)[:2], 1):
            assert [n for _, n in sorted(found[name, rank])] == path


def test_long_chain(spark):
    messages = spark.createDataFrame([("t", n, n - 1 if n else None, 0.0) for n in range(300)], "tree string, node long, parent long, score double")
    assert chat.chosen_paths(messages).count() == 300


def test_cycles_repeated_nodes_and_clashing_columns(spark):
    kind = "tree string, node long, parent long, score double, role string, text string"
    rows = [("a", 1, 2, 0.0, "user", "one"), ("a", 2, 1, 0.0, "assistant", "two"), ("a", 3, 2, 0.0, "user", "three"), ("a", 3, 2, 0.0, "user", "zzz"), ("a", None, 1, 0.0, "user", "lost")]
    rows += [("b", n, n - 1, 1.0, "user", f"b{n}") for n in range(1, 70)] + [("b", 0, 69, 1.0, "user", "b0")]
    rows += [("c", 7, 7, 0.0, None, None), ("c", 8, 99, 0.0, "user", "root of its own")]
    messages = spark.createDataFrame(rows, kind)
    for name in ("up", "leaf", "rank", "depth", "least", "n"):
        messages = messages.withColumn(name, F.lit(5))
    got = {(r["tree"], r["leaf"]): chat.read_turns(r["formatted"]) for r in chat.format_trees(messages, branches=None).collect()}
    assert got == {
        ("a", 3): [("user", "one"), ("assistant", "two"), ("user", "three")],
        ("b", 69): [("user", f"b{n}") for n in range(70)],
        ("c", 7): [("", "")],
        ("c", 8): [("user", "root of its own")],
    }
