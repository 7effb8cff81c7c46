"""Each operator against brute force on small fixtures: nulls, empty and long texts, ties, repeats, empty tables, extra columns."""

import collections
import hashlib
import itertools
import json
import random
import re
import zlib

import numpy as np
import pytest

DOCS = "doc_id long, text string, lang string, score double"
WORDS = [a + b for a in ("ba", "ke", "li", "mo", "nu", "sta", "tro") for b in ("ra", "sel", "tin", "dor", "pla", "")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = [(i, prose(rng, rng.randint(1, 120)), "xx", 0.5) for i in range(60)]
    base = prose(rng, 90).split()
    for i in range(60, 90):  # a large group of near copies
        w = list(base)
        w[rng.randrange(90)] = "new%d" % i
        out.append((i, " ".join(w), "xx", 0.5))
    out += [(90, None, None, None), (91, "", "xx", 0.1), (92, " \n\t", "xx", 0.1), (93, "one two", "xx", 0.1), (94, "ONE  two", "xx", 0.1)]
    out += [(95, out[3][1].upper(), "xx", 0.1), (96, prose(rng, 30000), "xx", 0.1), (3, out[3][1], "xx", 0.5), (None, out[4][1], "xx", 0.2)]
    return out


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def test_token_ids_equal_direct_encoding(spark, rows, tmp_path):
    from tokenizers import Tokenizer

    from tidemark.llm import queries, token_ids

    extra = rows[:40] + [(200, "a<|endoftext|>b", "", 0.0), (201, "日本 x²½ it's I'LL\x1f\x85 \xa0 y  ", "", 0.0)] + rows[90:]
    path = queries.vocabulary_file()
    got = token_ids.encoded_documents(frame(spark, extra), path, 2, str(tmp_path / "ids")).collect()
    tokenizer = Tokenizer.from_file(path)
    ids = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for i, t, *_ in extra]
    want = collections.Counter((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids)
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == list(itertools.accumulate([0] + [r.n_tokens for r in ordered[:-1]]))
    assert [r.doc_id for r in ordered] == sorted((i for i, _ in ids), key=lambda x: (x is not None, x))
    one = next(r for r in got if r.doc_id == 201)
    assert token_ids.read_range(spark, str(tmp_path / "ids"), one.start, one.start + one.n_tokens).tolist() == dict(ids)[201]


@pytest.mark.parametrize("bits", [1, 5, 8, 16, 17])
def test_packing_round_trip(bits):
    from tidemark.llm.token_ids import pack, unpack

    ids = np.random.default_rng(1).integers(0, 1 << bits, 777).astype(np.uint32)
    assert (unpack(pack(ids, bits), bits, 100, 701) == ids[100:701]).all()


def brute_groups(rows):
    sets = []
    for _, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    up = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = up[a], up[b]
            up = [x if u == y else u for u in up]
    least = {}
    for r, u in zip(rows, up, strict=True):
        if r[0] is not None:
            least[u] = min(least.get(u, r[0]), r[0])
    return sorted(((r[0], len(s), least.get(u)) for r, s, u in zip(rows, sets, up, strict=True)), key=str)


@pytest.mark.parametrize("small_group", [2, 8, 1000])
def test_jaccard_equals_brute_force(spark, rows, small_group):
    from tidemark.llm.jaccard import similar_documents

    got = similar_documents(frame(spark, rows), small_group=small_group).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_groups(rows)


def test_jaccard_counts_tokens_over_all_tasks(spark, monkeypatch):
    from tidemark.llm import jaccard

    rng, members, written = random.Random(8), [], jaccard.written
    line = prose(rng, 20)
    rows = [(i, prose(rng, 40) + " " + line) for i in range(40)] + [(40, prose(rng, 3))]
    rows += [(41 + i, rows[i][1] + " end") for i in range(3)]

    def spied(df):
        out = written(df)
        members.extend([out.count()] if out.columns == ["token", "node", "part"] else [])
        return out

    monkeypatch.setattr(jaccard, "written", spied)
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 22), "doc_id long, text string")  # two in each task
    got = jaccard.similar_documents(docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_groups(rows)
    assert members == [0]  # the line is in all texts, though in few of any task: no text is compared for its sake


def test_jaccard_token_counts():
    import pandas as pd

    from tidemark.llm import jaccard

    rng = np.random.default_rng(4)
    common = rng.integers(0, 1 << 32, 40, dtype=np.uint32)
    blocks = [np.concatenate([rng.integers(0, 1 << 32, 2_000_000 if i == 3 else 50, dtype=np.uint32), common[: 2 * i], [0, (1 << 32) - 1]]).astype(np.uint32) for i in range(21)]
    told = [(k, step, t) for b in blocks for of, step, tokens in [jaccard._sliced(b)] for k, t in zip(of.tolist(), tokens, strict=True)]
    assert {step for _, step, _ in told} == {2, 4}
    got = jaccard._counted(pd.DataFrame(told, columns=["slice", "step", "tokens"]))
    tokens, seen = np.unique(np.concatenate(blocks), return_counts=True)
    assert dict(zip(got["token"], got["seen"], strict=True)) == {int(t): int(n) for t, n in zip(tokens, seen, strict=True) if n > jaccard.FREQUENT}
    assert len(got) == 26


def test_components_of_chains_and_stars(spark):
    from tidemark.llm.common import components

    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(3, 3), (40, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()))
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(7, 41)} == {7}


def test_vectors_equal_brute_force(spark):
    from tidemark.llm.vectors import near_vectors

    rng = np.random.default_rng(2)
    base = rng.normal(size=(12, 8))
    rows = [(i, (base[i % 12] + rng.normal(size=8) * 0.08).tolist(), i % 2) for i in range(150)]
    rows += [(150 + i, base[0].tolist(), 0) for i in range(20)] + [(170, (base[0] * 3).tolist(), 0), (171, base[0].tolist(), None), (172, None, 0)]
    rows += [(173, [0.0] * 8, 0), (174, [float("nan")] * 8, 0), (175, [1.0, None] * 4, 0), (176, [1.0], 0), (177, [], 0), (3, rows[3][1], 1)]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), lists=6, parts=3).collect()
    ok = [v is not None and lab is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, lab in rows]
    up, links = list(range(len(rows))), [0] * len(rows)
    for a, b in itertools.combinations(range(len(rows)), 2):
        x, y = rows[a], rows[b]
        if ok[a] and ok[b] and x[2] == y[2] and len(x[1]) == len(y[1]):
            p, q = np.array(x[1]), np.array(y[1])
            if p @ q / np.sqrt(p @ p) / np.sqrt(q @ q) >= 0.98:
                links[a] += 1
                links[b] += 1
                s, t = up[a], up[b]
                up = [s if u == t else u for u in up]
    least = {}
    for r, u in zip(rows, up, strict=True):
        least[u] = min(least.get(u, r[0]), r[0])
    want = sorted((r[0], n, least[u], r[0] == least[u]) for r, n, u in zip(rows, links, up, strict=True))
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == want


def test_lines(spark):
    from tidemark.llm.lines import dedup_lines

    rows = [(1, "a\nb\nc\nd", 0), (2, "x\nb\nc\nd\ny", 0), (3, "a\nb\nc\nd\na\nb\nc", 0), (4, None, 0), (5, "b\nc", 0), (6, "\n\n\n\n", 0), (7, "\n\n\n", 0)]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, at int")).collect()}
    assert got == {1: (4, 0, "a\nb\nc\nd"), 2: (5, 3, "x\ny"), 3: (7, 7, ""), 4: (1, 0, ""), 5: (2, 0, "b\nc"), 6: (5, 0, "\n\n\n\n"), 7: (4, 0, "\n\n\n")}


def test_language_by_held_out_accuracy(spark):
    from pyspark.sql import functions as F

    from tidemark.llm import language

    rng = random.Random(1)
    kinds = {"aa": "the of and ing tion er".split(), "bb": "der die sch ung ü ß".split(), "cc": "que le eau é ou".split()}
    rows = [(i, " ".join(rng.choice(kinds[k]) for _ in range(rng.randint(5, 300))), k, 0.0) for i, k in enumerate(rng.choices(list(kinds), k=240))]
    rows += [(900, None, "aa", 0.0), (901, "12 !!", "aa", 0.0), (902, rows[0][1], None, 0.0)]
    docs = frame(spark, rows)
    net = language.train(docs, learn=F.col("doc_id") % 4 != 2)
    got = {r.doc_id: r for r in language.predict(docs, net).collect()}
    held = [r for r in rows if r[0] < 900 and r[0] % 4 == 2]
    assert sum(got[r[0]].lang_pred == r[2] for r in held) >= 0.95 * len(held)
    assert got[900].lang_pred == got[901].lang_pred == "und" and got[901].score == 0 and got[902].lang_pred == rows[0][2]
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language.train(docs.filter("false")) is None and language.predict(docs, None).filter("lang_pred <> 'und'").isEmpty()


def test_secrets(spark):
    from tidemark.llm.secrets import scan_secrets

    key, pass_ = "AKIA" + "A1" * 9, "Password = 'abc/def=='"
    weak = "user: bob1\npw xY7kQ2mPz9LwR4tBv8Ns end"
    rows = [(1, f"é {key} {pass_} " + "0a" * 12), (2, "token=token:secret99"), (3, weak), (4, weak.replace("\n", "\n \n")), (5, None), (6, weak.split("\n")[0])]
    got = {r.doc_id: r for r in scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = rows[0][1]
    spans = sorted([(text.index("AKIA"), "access", key), (text.index("Pass"), "assign", pass_[:-1]), (text.index("0a0a"), "hex", "0a" * 12)])
    joined = ",".join(f"{k}:{a}:{a + len(v)}" for a, k, v in spans)
    assert got[1].spans == joined and got[1].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
    assert (got[1].n_assign, got[1].n_access, got[1].n_hex) == (1, 1, 1)
    assert got[2].n_assign == 0 and got[5].spans == "" and got[5].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[3].n_linked == 2 and got[4].n_linked == got[6].n_linked == 0


def test_secrets_are_linked_at_all_offsets(spark):
    from tidemark.llm.secrets import _CLASS, scan_secrets, spans_of

    name, bare, url = "user=" + "r" * 40, "xY7kQ2mPz9LwR4tBv8Ns" * 3, "https://some.host.example/" + "path/" * 12
    rows = []
    for left, right in ((name, bare), (bare, name), (bare, url), (url, bare), (url, name)):
        rows += [" " * at + left + " " * gap + right for at in range(0, 60, 3) for gap in (130, 171, 199, 200, 201)]
    got = {r.doc_id: r.spans for r in scan_secrets(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), reach=200).collect()}
    small = {r.doc_id: r.spans for r in scan_secrets(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), reach=7).collect()}

    def linked(text, reach):  # these texts have one scope and no base spans
        _, weak = spans_of(text)
        near = lambda w, o: o[1] - w[2] <= reach and w[1] - o[2] <= reach and (_CLASS[w[0]] == 1) != (_CLASS[o[0]] == 1)
        return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted({w for w in weak if any(near(w, o) for o in weak)}, key=lambda w: (w[1], w[0], w[2])))

    for found, reach in ((got, 200), (small, 7)):
        assert found == {i: linked(t, reach) for i, t in enumerate(rows)}
    assert sum(x != "" for x in got.values()) >= 250


def test_forward_backward_equals_enumeration():
    from tidemark.llm.toxicity import forward_backward

    rng = np.random.default_rng(3)
    emit, move, n = rng.normal(size=(1, 6, 2)), rng.normal(size=(2, 2)), 4
    one, two = forward_backward(emit, move, np.array([n]))
    total, marginal, pairs = 0.0, np.zeros((n, 2)), np.zeros((2, 2))
    for y in itertools.product((0, 1), repeat=n):
        p = np.exp(sum(emit[0, t, y[t]] for t in range(n)) + sum(move[y[t], y[t + 1]] for t in range(n - 1)))
        total += p
        for t in range(n):
            marginal[t, y[t]] += p
        for t in range(n - 1):
            pairs[y[t], y[t + 1]] += p
    assert np.allclose(one[0, :n], marginal / total) and np.allclose(two[0], pairs / total)


def test_toxicity_on_held_out_rows(spark):
    from tidemark.llm import toxicity

    rng = random.Random(4)
    rows, marks = [], []
    for i in range(300):
        w, bad = prose(rng, 80).split(), rng.random() < 0.3
        for _ in range(3 * bad):
            w[rng.randrange(80)] = "zorp" + rng.choice(("ra", "sel", "tin"))
        rows.append((i, " ".join(w) + ".", "xx", 0.0))
        marks.append((i, int(bad)))
    docs = frame(spark, rows + [(900, None, "", 0.0), (901, "", "", 0.0)])
    crf = toxicity.learn(docs, spark.createDataFrame([m for m in marks if m[0] % 3 != 1], "doc_id long, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(docs, crf).collect()}
    assert all(got[i].predicted == bad for i, bad in marks if i % 3 == 1)
    assert all(rows[i][1][s.start : s.end].startswith("zorp") for i, bad in marks for s in got[i].toxic_spans)
    assert got[900].score == got[901].score < 0.5
    assert toxicity.learn(docs, spark.createDataFrame([], "doc_id long, toxic int")) is None


def test_tool_calls(spark):
    from tidemark.llm.tool_calls import linked_messages

    j = json.dumps
    tools = {"tools": [{"name": "f", "parameters": {"required": ["x"], "properties": {"x": {"type": "integer"}}}}]}
    calls = [{"id": "a", "name": "f", "arguments": {"x": 1, "b": {"z": 1, "a": 2}}}, {"id": "b", "name": "f", "arguments": {"x": "1"}, "depends_on": ["a"]}, {"id": "c", "name": "g", "arguments": {}}]
    rows = [(1, 0, "system", j(tools)), (1, 1, "assistant", j({"tool_calls": calls})), (1, 2, "tool", j({"tool_call_id": "b", "content": {"k": 2, "a": 1}})), (1, 3, "tool", j({"tool_call_id": "a"}))]
    rows += [(2, 0, "tool", j({"tool_call_id": "q", "content": 1})), (2, 1, "assistant", j({"tool_calls": [{"id": "q", "name": "f", "arguments": {}}, {"id": "q", "name": "f", "arguments": {}}]}))]
    rows += [(3, 0, "assistant", j({"tool_calls": [{"id": "m", "name": "f", "arguments": {}, "depends_on": ["n"]}, {"id": "n", "name": "f", "arguments": {}, "depends_on": ["m"]}]})), (None, 0, "user", None), (4, 0, "tool", "{bad")]
    got = linked_messages(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()
    at = {(r.conv_id, r.turn, r.part): r for r in got}
    assert [at[1, 1, k].status for k in range(3)] == ["ok", "invalid", "unknown_tool"]
    assert at[1, 1, 0].message == '{"role":"assistant","tool_call":{"arguments":{"b":{"a":2,"z":1},"x":1},"id":"a","name":"f"}}'
    assert at[1, 2, 0].depth == 2 and at[1, 3, 0].depth == 1
    assert (at[2, 0, 0].place, at[2, 0, 0].depth, at[2, 1, 1].status) == (1, 1, "duplicate")
    assert at[3, 0, 0].status == at[3, 0, 1].status == "cycle"
    assert at[None, 0, 0].message == '{"role":"user"}' and at[4, 0, 0].kind == "message" and len(got) == 13


def test_text_beside_tool_calls_stays(spark):
    from tidemark.llm.tool_calls import linked_messages

    j = json.dumps
    call = {"name": "f", "id": "a", "arguments": {"z": 1, "b": None}, "depends_on": ["q"], "type": "function"}
    rows = [(1, 0, "assistant", j({"tool_calls": [call, {"id": "b"}], "content": "let me \u00e9 see", "extra": {"k": 2, "a": [1]}, "role": "assistant"}))]
    rows += [(1, 1, "tool", j({"tool_call_id": "a", "is_error": True, "content": "x"})), (1, 2, "tool", j({"tool_call_id": "b", "content": None}))]
    rows += [(2, 0, "assistant", j({"content": None, "tool_calls": [call]}))]
    got = linked_messages(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()
    assert {(r.conv_id, r.turn, r.part): (r.kind, r.call_id, json.loads(r.message)) for r in got} == {
        (1, 0, 0): ("message", None, {"content": "let me \u00e9 see", "extra": {"a": [1], "k": 2}, "role": "assistant"}),
        (1, 0, 1): ("call", "a", {"role": "assistant", "tool_call": call}), (1, 0, 2): ("call", "b", {"role": "assistant", "tool_call": {"id": "b"}}),
        (1, 1, 0): ("result", "a", {"content": "x", "is_error": True, "role": "tool", "tool_call_id": "a"}),
        (1, 2, 0): ("result", "b", {"content": None, "role": "tool", "tool_call_id": "b"}),
        (2, 0, 0): ("call", "a", {"role": "assistant", "tool_call": call}),
    }
    at = {(r.conv_id, r.turn, r.part): r.message for r in got}
    assert at[1, 0, 0] == '{"content":"let me \u00e9 see","extra":{"a":[1],"k":2},"role":"assistant"}'
    assert at[1, 0, 1].startswith('{"role":"assistant","tool_call":{"arguments":{"b":null,"z":1},"depends_on":["q"],"id":"a"')
    assert len(got) == 6


def test_decontamination(spark):
    from tidemark.llm.decontaminate import contaminated

    item = "The train leaves station Alpha at 10 with 25 km to go and the train of Bruno passes Alpha after 25 km of its way home"
    other = item.replace("Alpha", "Omega").replace("10", "17").replace("25 km", "40 km").replace("Bruno", "Carla")
    mixed = item.replace("Alpha at", "Omega at").replace("10", "17").replace("25 km of", "41 km of")
    rows = [(1, "before. " + item.lower() + " after", "", 0.0), (2, "x y z. " + other, "", 0.0), (3, mixed, "", 0.0), (4, "nothing of it", "", 0.0), (5, None, "", 0.0), (6, item, "", 0.0), (6, item, "", 0.0)]
    items = spark.createDataFrame([(7, item), (8, "short one"), (9, None)], "item_id long, text string")
    got = {r.doc_id: r for r in contaminated(frame(spark, rows), items).collect()}
    assert {2, 6} <= set(got) and got[2].slots_agree and got[6].n_windows == got[6].item_windows
    assert 4 not in got and 5 not in got and (3 not in got or not got[3].slots_agree)


def leaked(spark, items, texts):
    from tidemark.llm.decontaminate import contaminated

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = contaminated(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    assert len({(r.doc_id, r.item_id) for r in out}) == len(out)
    return {r.doc_id: r for r in out}


def test_decontamination_windows_are_told_apart_by_their_tokens(spark):
    """Of every width, one hash for each place, equal where the tokens are; other widths and kinds have other hashes."""
    from tidemark.llm.decontaminate import _runs, windows

    lists = [[1, 2, 3] * 6, [1, 2, 3, 1, 2, 4, 1, 2, 3, 1, 2, 3, 9], [2, 1], [], [5]]
    rows = _runs(spark.createDataFrame(list(enumerate(lists)), "i int, codes array<long>"), "codes", 9)
    made = [(n, kind) for n in (1, 2, 3, 5, 8, 9) for kind in (0, 1)]
    told = {}
    for row in rows.select("i", *(windows("codes", n, kind).alias(f"w{n}_{kind}") for n, kind in made)).collect():
        codes = lists[row.i]
        for n, kind in made:
            want = [(kind, *codes[at : at + n]) for at in range(len(codes) - n + 1)]
            assert len(row[f"w{n}_{kind}"]) == len(want)
            assert all(told.setdefault(w, h) == h for w, h in zip(want, row[f"w{n}_{kind}"], strict=True))
    assert len(set(told.values())) == len(told)


def test_decontamination_windows_are_made_once_as_a_column(spark, monkeypatch):
    """The generator reads them: windows made inside it would take every probing row out of compiled code, and a filter would make them again."""
    from tidemark.llm import decontaminate

    plans, write = [], decontaminate.written
    monkeypatch.setattr(decontaminate, "written", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df))
    texts = ["so one two three four five six seven eight nine", None, "", "one two", "two three", "one, two three"]
    assert leaked(spark, ["one two three four five six seven eight nine", "two three"], texts).keys() == {0, 4, 5}
    probe = next(p for p in plans if "LeftSemi" in p and "posexplode" in p).splitlines()
    asked = [line for line in probe if re.match(r"[ :+*()\d-]*(Generate posexplode|Filter)", line)]
    assert any("Generate" in line for line in asked) and not any("transform(" in line for line in asked)


def test_decontamination_by_occurrence(spark):
    item = "a boat takes 10 km of water to reach Alpha in 3 days and then 25 km more to Bruno where 40 people wait for 12 boats that carry 7 goods from Carla to Delta"
    change = lambda *v: re.sub(r"\d+", lambda m, it=iter(v): str(next(it)), item)
    one, two = change(11, 4, 26, 41, 13, 8), change(19, 5, 27, 42, 14, 9).replace("Alpha", "Omega")
    stray = "they say that a boat takes 99 km of water to reach it"
    long = lambda t: t.replace(" and then", " so they all tell us here and then")
    conflict = item.replace("25 km", "31 km") + ". nothing else. " + item.replace("25 km", "32 km")
    got = leaked(spark, [item], [one + ". and so on. " + two, item + ". " + stray, long(one) + ". and so on. " + long(two), stray, conflict])
    assert set(got) == {0, 1, 2, 4} and all(got[i].slots_agree for i in got)
    assert all(got[i].n_windows == got[i].item_windows for i in (0, 1, 4))
    # One value of the item for two of the document in one occurrence: only windows with the item's own values or none.
    twice = "from Alpha to it 10 km and then back to Alpha with 10 km to go until we see Alpha after 10 km of it"
    bad = re.sub("10", lambda m, it=iter("123"): next(it), twice)
    assert not leaked(spark, [twice], [bad])


def test_decontamination_of_verbatim_copies(spark):
    item = "The train leaves station Alpha at 10 with 25 km to go and the train of Bruno passes Alpha after 25 km of its way home"
    dense = "1 2 3 4 5 and 6 7 8 9 10 11 or 12 13 14 15 16"
    wrapped = re.sub(r" (?=[A-Z\d])|(?<=\d) ", "\n\t", item)
    texts = [item.lower(), item.upper(), wrapped, wrapped.replace("10", "17").replace("25", "40"), "so " + dense, dense.replace("7", "70").replace("12", "13")]
    texts += ["what is the Answer to it", "the answer is", "Say: the answer\nto it!", item.replace(" ", "\u00a0")]
    got = leaked(spark, [item, dense, "answer to it"], texts)
    assert {i: r.item_id for i, r in got.items()} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 1, 6: 2, 8: 2, 9: 0}
    assert got[2].n_windows == got[2].item_windows and got[3].slots_agree


def test_mixing_meets_targets(spark, rows):
    from tidemark.llm import mixing

    rng = random.Random(8)
    docs = [(i, prose(rng, 60) + " junk***" * (i % 5 == 0) * 30, "", 0.0) for i in range(200)] + rows[90:93]
    labels = spark.createDataFrame([(i, int(i % 5 != 0), int(i % 11 == 0)) for i in range(120)], "doc_id long, quality int, toxic int")
    df = frame(spark, docs)
    model = mixing.fit_rates(df, mixing.learn_domains(df, labels), {"good": 0.8, "poor": 0.15, "toxic": 0.05})
    got = mixing.with_rates(df, model).collect()
    totals = [sum(r.n_tokens * r.rate * r[f"p_{d}"] for r in got) for d in mixing.DOMAINS]
    assert np.allclose(totals, [model.targets[d] for d in mixing.DOMAINS], rtol=1e-3) and min(r.rate for r in got) >= 0
    assert all(r.copies in (int(np.floor(r.rate)), int(np.floor(r.rate)) + 1) for r in got) and len(got) == len(docs)


def test_mixing_runs_its_classifier_once(spark, rows, monkeypatch):
    """A task that runs it twice keeps twice the workers, which stay for the stages after."""
    import corpus_pipeline as p
    from tidemark.llm import mixing

    plans, write = [], mixing.written
    monkeypatch.setattr(mixing, "written", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df))
    docs = spark.createDataFrame([(*r[:2], "en", r[2], 1) for r in rows[:60]] + [(-1, None, "en", "s", 1), (-2, "", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    out = p.mix_sources(spark, docs, "/root/testdata/sf0.001")
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert [t.count("ArrowEvalPython") for t in plans if "ArrowEvalPython" in t] == [1, 1]
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} <= {r.doc_id for r in docs.collect()}


def test_empty_tables(spark):
    from tidemark.llm import language, mixing, queries, toxicity
    from tidemark.llm.decontaminate import contaminated
    from tidemark.llm.jaccard import similar_documents
    from tidemark.llm.lines import dedup_lines
    from tidemark.llm.secrets import scan_secrets
    from tidemark.llm.token_ids import encoded_documents
    from tidemark.llm.tool_calls import linked_messages
    from tidemark.llm.vectors import near_vectors

    docs = frame(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    empty = [
        encoded_documents(docs, queries.vocabulary_file()), near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")), dedup_lines(docs),
        language.predict(docs, language.train(docs)), scan_secrets(docs), toxicity.score(docs, toxicity.learn(docs, labels.select("doc_id", "toxic"))),
        linked_messages(spark.createDataFrame([], "conv_id long, turn int, role string, text string")),
        contaminated(docs, spark.createDataFrame([], "item_id long, text string")), similar_documents(docs), mixing.with_rates(docs, mixing.fit_rates(docs, mixing.learn_domains(docs, labels))),
    ]
    assert [df.count() for df in empty] == [0] * len(empty)


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in p.STAGES:
        out = stage(spark, docs, sf_dir).collect()
        if name == "ngram_jaccard":
            want = sorted(i for i, _, c in brute_groups(sorted(before.items())) if i == c)
            assert sorted(r.doc_id for r in out) == want
        if name == "decontaminate":
            items = [r.text.lower() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            assert {r.doc_id for r in out} == {i for i, t in before.items() if not any(x in t.lower() for x in items)}
        if name == "token_ids":
            assert [r.doc_id for r in sorted(out, key=lambda r: r.start)] == sorted(r.doc_id for r in docs.collect())
        else:
            assert all(before[r.doc_id] == r.text for r in out) and docs.columns == list(out[0].__fields__)
            docs = spark.createDataFrame(out, docs.schema)
            before = {r.doc_id: r.text for r in out}


def test_language_stage_rejects_foreign_and_junk(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.filter("doc_id % 2 = 0").collect()
    labelled = [tuple(r[c] for c in p.COLUMNS) for r in rows]
    out = ["Это предложение написано на русском языке, и его никто не знает", "これは日本語で書かれた文章です", "Az időjárás ma nagyon szép ezért kimentünk a kertbe",
           "aGVsbG8gd29ybGQ= 9f8a7 ##!! zxqwv kjhgf", "qwrtz plkjh mnbvc xzlkj qpwoe rutyz", "12 !!", None]
    strange = [(-1 - i, t, None, "src0", 0) for i, t in enumerate(out)]
    both = [(-100 - i, a.text[:400] + " " + b.text[:400], None, "src0", 0) for i, (a, b) in enumerate(zip(rows[:20], rows[20:40])) if min(len(a.text), len(b.text)) > 400]
    df = spark.createDataFrame(labelled + strange + both, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in p.language_id(spark, df, "").collect()}
    assert not kept & {r[0] for r in strange} and {r[0] for r in both} <= kept
    for lang in {r.lang for r in rows}:
        mine = [r.doc_id for r in rows if r.lang == lang]
        assert sum(i in kept for i in mine) >= 0.99 * len(mine)


def test_pipeline_decides_by_row(spark):
    import corpus_pipeline as p

    rng = random.Random(6)
    a, b, c, d = (prose(rng, 60) for _ in range(4))
    near = lambda t: t + " end"
    item = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").first().text
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, a), (None, b), (None, near(b)), (5, c), (5, d), (3, near(c)), (7, d), (7, d), (9, None), (None, None), (None, "")]
    df = lambda x: spark.createDataFrame([(i, t, "en", "s", 1) for i, t in x], schema)
    out = collections.Counter((r.doc_id, r.text) for r in p.ngram_jaccard(spark, df(rows), "").collect())
    assert out[None, a] == 1 and out[None, b] + out[None, near(b)] == 1 and out[3, near(c)] == 1 and out[5, d] == 1
    assert out[9, None] == out[None, None] == out[None, ""] == 1 and sum(out.values()) == 7
    rows = [(None, a + " " + item), (None, a), (5, c), (5, item), (6, None)]
    out = collections.Counter((r.doc_id, r.text) for r in p.decontaminate(spark, df(rows), "/root/testdata/sf0.001").collect())
    assert out == collections.Counter([(None, a), (5, c), (6, None)])


def test_stages_keep_no_more_scratch_than_their_results_read(spark, tmp_path, monkeypatch):
    import corpus_pipeline as p
    from tidemark.operators import scratch

    monkeypatch.setattr(scratch, "shared_folder", lambda spark: str(tmp_path))
    rng = random.Random(7)
    item = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").first().text
    texts = [prose(rng, 60) for _ in range(8)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate([*texts, texts[0], texts[1] + " end", texts[2] + " " + item])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    tables = lambda: {d for d in tmp_path.rglob("tidemark-*") if any(d.glob("*.parquet"))}
    stages, want, most = dict(p.STAGES), [set(range(8)) | {10}, set(range(10))], {"ngram_jaccard": 2, "decontaminate": 1, "mix_sources": 0}
    for name, most_tables in most.items():
        before = tables()
        out = stages[name](spark, docs, "/root/testdata/sf0.001")
        assert len(tables() - before) <= most_tables, name
        kept = {r.doc_id for r in out.collect()}
        assert name == "mix_sources" or kept == want.pop(0)


def test_whole_pipeline_keeps_its_last_table_alone(spark, tmp_path, monkeypatch):
    import corpus_pipeline as p
    from tidemark.operators import scratch

    monkeypatch.setattr(scratch, "shared_folder", lambda spark: str(tmp_path))
    monkeypatch.setattr(p, "STAGES", [(n, s) for n, s in p.STAGES if n != "language_id"])
    out = p.run(spark, "/root/testdata/sf0.001")
    assert len([d for d in tmp_path.rglob("tidemark-*") if any(d.glob("*.parquet"))]) == 1
    rows = sorted(out.collect(), key=lambda r: r.start)
    assert [r.start for r in rows] == [0, *itertools.accumulate(r.n_tokens for r in rows)][:-1] and len(rows) > 100
