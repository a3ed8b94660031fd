"""Recursive text-leaf flatten -- hand-made trees and a property test."""

from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ferry.operators.nested import text_leaves


def expected_leaves(text, prefix="http"):
    """The leaves by an explicit stack over parsed key/value pairs: objects
    are lists of pairs here, repeated keys settled before they are walked."""
    class Pairs(list):
        pass

    def settled(pairs):
        last = dict(pairs)
        return Pairs((k, last[k]) for k in dict.fromkeys(k for k, _ in pairs))

    stack = [iter(json.loads(text, object_pairs_hook=settled))]
    out = []
    while stack:
        pair = next(stack[-1], None)
        if pair is None:
            stack.pop()
        elif isinstance(pair[1], Pairs):
            stack.append(iter(pair[1]))
        elif isinstance(pair[1], str) and pair[1].startswith(prefix):
            out.append(pair)
    return out


def run(spark, docs, root=None):
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, doc string")
    rows = text_leaves(df, "doc_id", "doc", root=root).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.leaf_pos)):
        got.setdefault(r.doc_id, []).append((r.key, r.value))
    return got


def test_document_order_depth_first(spark):
    doc = ('{"s": {"a": "http://1", "o": {"x": {"y": "http://2"}, "z": "http://3"},'
           ' "b": "http://4"}}')
    assert run(spark, [doc], root="$.s") == {0: [("a", "http://1"), ("y", "http://2"),
                                                 ("z", "http://3"), ("b", "http://4")]}


def test_drops_lists_numbers_nulls_upper_and_json_text(spark):
    doc = json.dumps({"s": {"l": ["http://x"], "n": 5, "nul": None, "u": "HTTP://X",
                            "trap": json.dumps({"u": "http://in-text"}), "e": {},
                            "lo": [{"a": "http://in-list"}], "ok": "httpfoo"}})
    assert run(spark, [doc], root="$.s") == {0: [("ok", "httpfoo")]}


def test_repeated_key_first_position_last_value(spark):
    doc = '{"s": {"a": "http://1", "b": "http://2", "a": "http://3"}}'
    assert run(spark, [doc], root="$.s") == {0: [("a", "http://3"), ("b", "http://2")]}
    assert expected_leaves(doc[6:-1]) == [("a", "http://3"), ("b", "http://2")]


def test_repeated_key_object_replaced_by_text(spark):
    doc = '{"s": {"a": {"x": "http://deep"}, "b": "http://2", "a": "http://3"}}'
    assert run(spark, [doc], root="$.s") == {0: [("a", "http://3"), ("b", "http://2")]}


@pytest.mark.parametrize("doc", ['{"other": {"a": "http://x"}}', '{"s": null}', '{}'])
def test_missing_or_null_root_fails(spark, doc):
    with pytest.raises(Exception):
        run(spark, [doc], root="$.s")


def test_malformed_document_fails(spark):
    with pytest.raises(Exception):
        run(spark, ['{"s": {"a": "http://x"'], root="$.s")


def test_any_depth(spark):
    doc = '{"n": ' * 100 + '{"x": "http://deep"}' + ', "y": "http://up"}' * 100
    got = run(spark, [doc, '{"x": "http://flat"}'])
    assert got[0] == [("x", "http://deep")] + [("y", "http://up")] * 100
    assert got[1] == [("x", "http://flat")]


_keys = st.text(alphabet="abcdefgh-_", min_size=1, max_size=4)
_leaf = st.one_of(st.sampled_from(["http://a", "https://b", "HTTP://c", "httpx", "ftp://d", ""]),
                  st.integers(-5, 5), st.none(), st.booleans(),
                  st.lists(st.just("http://in-list"), max_size=2))
_tree = st.recursive(_leaf, lambda kids: st.dictionaries(_keys, kids, max_size=4),
                     max_leaves=12)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.dictionaries(_keys, _tree, max_size=5), min_size=1, max_size=6))
def test_matches_recursive_definition(spark, trees):
    docs = [json.dumps(t) for t in trees]
    want = {i: expected_leaves(t) for i, t in enumerate(docs) if expected_leaves(t)}
    assert run(spark, docs) == want


@pytest.mark.parametrize("per_pass", [1, 2, 3, 8])
def test_pass_boundaries(spark, per_pass):
    tree = {"a": "http://0"}
    node = tree
    for d in range(1, 7):
        node["n"] = {"x": f"http://{d}", "num": d}
        node["z"] = f"http://z{d}"
        node = node["n"]
    df = spark.createDataFrame([(0, json.dumps(tree))], "doc_id long, doc string")
    rows = text_leaves(df, "doc_id", "doc", levels_per_pass=per_pass).orderBy("leaf_pos").collect()
    assert [(r.key, r.value) for r in rows] == expected_leaves(json.dumps(tree))


def test_deep_root_path(spark):
    doc = '{"a": {"b": {"x": "http://1", "y": {"z": "http://2"}}}, "c": "http://no"}'
    assert run(spark, [doc], root="$.a.b") == {0: [("x", "http://1"), ("z", "http://2")]}


def test_wide_object_with_repeated_keys(spark):
    import random
    rnd = random.Random(7)
    pairs = [(f"k{rnd.randrange(3000)}", f"http://v/{i}") for i in range(5000)]
    pairs.insert(100, ("nested", {"a": "http://deep"}))
    text = "{" + ",".join(f"{json.dumps(k)}:{json.dumps(v)}" for k, v in pairs) + "}"
    want = expected_leaves(text)
    assert run(spark, [text]) == {0: want}
