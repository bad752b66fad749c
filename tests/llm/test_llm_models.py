"""Decontamination, mixing, toxicity, language model, vectors, pages and quotations."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quern.llm import language_model, toxicity
from quern.llm.decontaminate import decontaminate
from quern.llm.mixture import mix_sources
from quern.llm.near_vectors import near_duplicate_vectors
from quern.llm.quotations import link_quotations
from quern.llm.wrappers import Part, expression, extract_main_text, infer_wrappers, main_text, merge, read, shape


def test_decontamination(spark):
    rng = random.Random(3)
    vocabulary = ["a", "b", "C", "dé", "e1"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 9)))) for i in range(8)]
    items += [(None, "b b b b"), (9, None), (10, "!!")]
    docs = [(i, " ".join(rng.choice([*vocabulary, "zz"]) for _ in range(rng.randint(0, 80)))) for i in range(100)]
    docs += [(900, None), (901, ""), docs[0]]
    n = 5

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    windows = {}
    for i, t in items:
        w = words(t)
        parts = [tuple(w[k : k + n]) for k in range(len(w) - n + 1)] if len(w) >= n else [tuple(w)] if w else []
        for p in parts:
            windows.setdefault(p, set()).add("" if i is None else str(i))
    wanted = []
    for i, t in docs:
        w, found = words(t), set()
        hit = [False] * len(w)
        for p, ids in windows.items():
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k : k + len(p)]) == p:
                    found |= ids
                    hit[k : k + len(p)] = [True] * len(p)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        wanted.append((i, len(w), sum(hit), len(found), digest, sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    rows = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, out string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    for block in (500_000, 10):
        got = decontaminate(rows, tests, n=n, block_words=block).select(
            "row.doc_id", "out.n_words", "out.n_hit", "out.n_items", "out.items_sha256", "out.contaminated"
        )
        assert sorted(map(tuple, got.collect())) == sorted(wanted)
    one = spark.createDataFrame([(1, "x, One TWO three. y")], "doc_id long, text string")
    short = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert decontaminate(one, short).first()["out"]["clean"] == "x, . y"
    assert decontaminate(rows.where("false"), tests).count() == 0
    assert decontaminate(rows, tests.where("false")).where("out.n_hit > 0").count() == 0


def test_mixture(spark):
    docs = [(i, "a", 10, 1.0) for i in range(2000)] + [(i + 5000, "b", 7, None) for i in range(100)]
    docs += [(i + 9000, None, 3, 0.0) for i in range(50)] + [(9999, "c", None, 1.0), (9999, "c", 0, 1.0)]
    rows = spark.createDataFrame(docs, "doc_id long, source string, size int, q double")
    out = mix_sources(rows, quality_col="q")
    got = out.select("row.*", "out.taken", "out.target", "out.source_size").toPandas()
    assert len(got) == len(docs)
    sums = got.groupby("source", dropna=False).agg({"taken": "sum", "target": "first", "source_size": "first"})
    assert (abs(sums["taken"] - sums["target"]) <= 10).all()
    assert (got["taken"] <= 3 * got["size"].fillna(0)).all()
    total = sums["source_size"].sum()
    assert abs(sums["target"].sum() - total) < 1e-6
    assert sums.loc["b", "target"] == 3 * 700 and sums.loc["c", "target"] == 0
    again = mix_sources(rows.repartition(7), quality_col="q").select("row.*", "out.taken").toPandas()
    key = ["doc_id", "taken"]
    assert got[key].sort_values(key).values.tolist() == again[key].sort_values(key).values.tolist()
    assert mix_sources(rows.where("false")).count() == 0


def test_ordinal_regression_orders_grades():
    rng = np.random.default_rng(1)
    n, f = 1200, 40
    strength = rng.normal(size=f)
    x = rng.random((n, f)) < 0.2
    s = x @ strength + rng.logistic(size=n) * 0.3
    grades = np.digitize(s, np.quantile(s, [0.5, 0.75, 0.9]))
    rows, cols = np.nonzero(x)
    model = toxicity.fit(rows[rows < 900], cols[rows < 900], grades[:900], np.arange(f), 4)
    assert (np.diff(model.thresholds) > 0).all()
    scores = x[900:] @ np.array([model.weights[i] for i in range(f)])
    expected = model.at_least(scores).sum(axis=1)
    means = [expected[grades[900:] == g].mean() for g in range(4)]
    assert means == sorted(means)
    assert np.abs(expected - grades[900:]).mean() < 0.5


def test_toxicity_on_held_out_texts(spark):
    rng = random.Random(2)
    plain = [f"wort{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(600):
        w = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        bad = i % 4 == 0
        if bad:
            w[:2] = rng.sample(["idiot", "moron", "scum", "trash"], 2)
        docs.append((i, " ".join(w)))
        if i < 400:
            labels.append((i, int(bad)))
    docs += [(1000, None), (1001, ""), docs[0]]
    rows = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, out int")
    known = spark.createDataFrame(labels + [(5, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(rows, known)
    got = {r["row"]["doc_id"]: r["out"] for r in toxicity.score(rows, model).collect()}
    assert all((got[i]["grade"] > 0) == (i % 4 == 0) for i in range(400, 600))
    assert got[1000] == got[1001] and got[1000]["grade"] == 0
    assert toxicity.score(rows, toxicity.train(rows, known.where("false"))).where("out.grade > 0").count() == 0


def test_rare_toxic_words_count(spark):
    rng = random.Random(4)
    plain = [f"wort{i}" for i in range(200)]
    docs, labels, rare = [], [], ["qzzug", "xyffo", "vrukk", "jwopp"]
    for i in range(640):
        w = [rng.choice(plain) for _ in range(rng.randint(5, 40))]
        bad = i % 4 == 0
        if bad:
            w[0] = rare[i // 4 % 4] if i < 48 or i >= 600 else "idiot"
        docs.append((i, " ".join(w)))
        if i < 600:
            labels.append((i, int(bad)))
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.train(rows, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r["row"]["doc_id"]: r["out"]["grade"] for r in toxicity.score(rows, model).collect()}
    assert all((got[i] > 0) == (i % 4 == 0) for i in range(600, 640))


def test_threshold_of_fewest_errors():
    toxic = np.array([False, False, True, True])
    assert toxicity.shift(np.array([-3.0, -1.0, 2.0, 4.0]), toxic) == 0
    assert toxicity.shift(np.array([-3.0, 1.0, 2.0, 4.0]), toxic) == 1.5


def test_language_model(spark):
    rng = random.Random(4)
    a, b = [f"la{i}" for i in range(30)], [f"der{i}x" for i in range(30)]
    docs = [(i, " ".join(rng.choice(a if i % 2 else b) for _ in range(rng.randint(1, 80)))) for i in range(400)]
    docs += [(1000, None), (1001, ""), (1002, "Unknown words"), docs[3]]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    held = language_model.held_out(rows["doc_id"])
    taught = [r["text"] for r in rows.where(~held).collect()]
    counts, n = {}, 0
    for t in taught:
        for w in [*(t or "").lower().split(), None]:
            counts[w] = counts.get(w, 0) + 1
            n += 1
    for most in (1_000_000, 40):  # all counts shipped; most of them joined
        model = language_model.train(rows.where(~held), most_frequent=most)
        got = language_model.score(rows, model)
        by_id = {r["id"]: r for r in got.collect()}
        for i, t in docs:
            w = [*(t or "").lower().split(), None]
            base = sum(np.log10((counts.get(x, 0) + 1) / (n + len(counts) + 1)) for x in w)
            r = by_id[i]
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(x in counts for x in w), n)
            assert abs(r["base_score"] - base) < 1e-6 * max(1, abs(base))
        unseen = [r["doc_id"] for r in rows.where(held).collect() if r["doc_id"] < 1000]
        assert sum(by_id[i]["score"] for i in unseen) > sum(by_id[i]["base_score"] for i in unseen)
        assert by_id[1000]["score"] == by_id[1001]["score"]


def test_language_model_expects_by_rows_of_a_class(monkeypatch):
    from types import SimpleNamespace

    import pyarrow as pa

    rng = random.Random(9)
    docs = [None, "", *(" ".join(rng.choice(["ab", "b", "Ca", "dd"]) for _ in range(rng.randint(0, 40))) for _ in range(20))]
    batch = pa.RecordBatch.from_pylist([{"row": {"text": t}} for t in docs])
    weights = np.random.default_rng(2).normal(size=language_model.SHAPE).astype(np.float32)
    wanted = np.zeros(language_model.SHAPE)
    for t in language_model.texts(language_model.field(batch, "text")):
        k = language_model.tokens(t)
        z = np.exp(sum(weights[f][k.buckets[f]].astype(float) for f in range(language_model.FEATURES)))
        for f in range(language_model.FEATURES):
            np.add.at(wanted[f], k.buckets[f], z / z.sum(axis=1, keepdims=True))
    monkeypatch.setattr(language_model, "PIECE", 7)  # pieces end within texts
    (got,) = language_model._expect(SimpleNamespace(value=weights), "text")(iter([batch]))
    sums = np.frombuffer(got.column("sums")[0].as_buffer(), np.float32).reshape(language_model.SHAPE)
    assert np.allclose(sums, wanted, rtol=1e-4, atol=1e-5)


def test_language_model_chances_sum_to_one():
    from quern.llm.hashing import Texts

    data = np.frombuffer(b"one two three", np.uint8)
    k = language_model.tokens(Texts(data, np.array([0]), np.array([len(data)]), 0))
    weights = np.random.default_rng(1).normal(size=language_model.SHAPE).astype(np.float32)
    assert len(k.hashes) == 4
    assert np.allclose(language_model._chances(weights, k).sum(axis=1), 1, atol=1e-5)


def test_language_model_has_features_of_words_within_a_class(spark):
    """Scores against plain loops; the chances of a class's words add up to one after any word."""
    from quern.llm.hashing import texts

    rng = random.Random(6)
    words = [f"{a}{b}" for a in "klmnop" for b in ("ab", "ab", "xab", "yab", "q")]
    docs = [(i, " ".join(rng.choice(words[i % 7 :: 3]) for _ in range(rng.randint(0, 30)))) for i in range(120)]
    docs += [(500, None), (501, "never Kab met"), (502, "kab kab kab"), docs[3]]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    held = language_model.held_out(rows["doc_id"])
    taught = [r["text"] for r in rows.where(~held).collect()]

    def read(text):
        k = language_model.tokens(next(texts(pa.array([text], pa.string()))))
        seen = ["<", *(text or "").lower().split(), ">"]
        return k, list(zip(seen, seen[1:], k.classes.tolist()))

    ones, twos, contexts, kind = Counter(), Counter(), Counter(), {}
    for text in taught:
        for before, word, c in read(text)[1]:
            ones[word] += 1
            twos[before, word] += 1
            contexts[before, c] += 1
            kind[word] = c
    size, different = Counter(), Counter(kind.values())
    for word, n in ones.items():
        size[kind[word]] += n

    def chance(before, word, c):
        share = (ones[word] + 1) / (size[c] + different[c] + 1)
        n = contexts[before, c]
        if not n:
            return share
        left = 0.75 * sum(1 for b, w in twos if b == before and kind[w] == c) / n
        return max(twos[before, word] - 0.75, 0) / n + left * share

    for before, c in contexts:
        known = [w for w in ones if kind[w] == c]
        assert sum(chance(before, w, c) for w in known) + chance(before, "unknown", c) == pytest.approx(1)
    for frequent, features in ((1_000_000, 1_000_000), (7, 9)):
        model = language_model.train(rows.where(~held), most_frequent=frequent, most_features=features)
        got = {r["id"]: r["score"] for r in language_model.score(rows, model).collect()}
        for i, text in docs:
            k, read_in = read(text)
            p = language_model._chances(model.weights, k)[np.arange(len(k.classes)), k.classes]
            want = sum(math.log10(x * chance(*token)) for x, token in zip(p.tolist(), read_in))
            assert got[i] == pytest.approx(want, rel=1e-5, abs=1e-4)


def test_vectors_recall(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(2500, 16))
    near = base[:600] + rng.normal(size=(600, 16)) * 0.2
    x = np.concatenate((base, near, base[:5], 3 * base[:5]))
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)]
    rows += [(9000, None, "x"), (9001, [0.0] * 16, "x"), (9002, [float("nan")] * 16, "x"), (9003, [1.0, None], "x"), (9004, [], "x"), (9005, [1.0, 2.0], "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node string")
    got = {r["row"]["vec_id"]: r["out"] for r in near_duplicate_vectors(table, cell_rows=300, block=64).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = u @ u.T >= 0.95
    np.fill_diagonal(links, False)
    found = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (found <= links.sum(axis=1)).all()
    assert found.sum() >= 0.97 * links.sum() > 0
    exact = {r["row"]["vec_id"]: r["out"] for r in near_duplicate_vectors(table, cell_rows=300, block=64, margin=0.64).collect()}
    assert [exact[i]["n_links"] for i in range(len(x))] == links.sum(axis=1).tolist()
    root = np.arange(len(x))
    while True:
        least = np.minimum(root, np.where(links, root[None, :], len(x)).min(axis=1))
        if (least == root).all():
            break
        root = least
    assert [exact[i]["component_id"] for i in range(len(x))] == root.tolist()
    for i in range(9000, 9006):
        assert got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"]
    assert near_duplicate_vectors(table.where("false")).count() == 0


PAGE = (
    "<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t='</p>';</script></head><body>"
    "<nav><ul>{menu}</ul></nav><!-- ad --><div class='ad box'>Buy</div><div id=content>{body}</div>"
    "<div class='comments'><p>first!</p></div><form><p>mail</p></form><footer>&copy; x</footer></body></html>"
)


def page(paragraphs, menu=3, article=True):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    body = f"<article><h1>Head</h1>{body}</article>" if article else f"<h1>Head</h1>{body}"
    return PAGE.replace("{menu}", "<li><a href=/a>m</a></li>" * menu).replace("{body}", body)


def test_wrappers():
    one, two = shape(read("<div><p>a<p>b</div>")), shape(read("<div><h1>t</h1><p>a</p></div>"))
    assert expression(merge(one, two)) == "<#root><div>(<h1>#text</>)?(<p>#text</>)+</></>"
    pairs = shape(read("<dl><dt>a</dt><dd>b</dd><dt>c</dt><dd>d</dd></dl>"))
    assert expression(pairs) == "<#root><dl>(<dt>#text</><dd>#text</>)+</></>"
    assert main_text("<p><b>a&amp;\n b<br><p>c&lt;i&gt;", None) == "a& b c<i>"
    assert main_text(None, None) == main_text("", "/#root/html") == ""


def test_pages(spark):
    rows = []
    for h in range(3):
        for i in range(12):
            paragraphs = [f"text {h} {i} {k} of some length&nbsp;here" for k in range(i % 4 + 1)]
            rows.append((h * 100 + i, f"https://h{h}.org/{i}", page(paragraphs, i % 3 + 1, h != 1)))
    rows += [(900, None, None), (901, "x", ""), (902, "https://h0.org/z", "<article><p>cut <b>off"), rows[0]]
    table = spark.createDataFrame([(*r, "w") for r in rows], "page_id long, url string, html string, wrapper string")
    got = {r["row"]["page_id"]: r["out"] for r in extract_main_text(table).collect()}
    for i, _, _ in rows[:36]:
        h, k = divmod(i, 100)
        wanted = ["Head", *(f"text {h} {k} {j} of some length here" for j in range(k % 4 + 1))]
        assert got[i]["text"] == " ".join(wanted)
        assert got[i]["n_chars"] == len(got[i]["text"])
    assert got[900]["text"] == got[901]["text"] == "" and got[902]["text"] == "cut off"
    wrappers = {r["host"]: r for r in infer_wrappers(table, slice_shapes=2).collect()}
    assert wrappers["h0.org"]["main"].endswith("/article") and "(<p>#text</>)+" in wrappers["h0.org"]["wrapper"]
    assert extract_main_text(table.where("false")).count() == 0


def test_template_text(spark):
    """Text that all pages of a host share goes, whatever its tags; a heading above text stays."""
    rows = []
    for i in range(8):
        menu = "".join(f"<li>{w}</li>" for w in ("Home", "World", "About us"))
        body = "".join(f"<p>story {i} part {k} with <b>words</b></p>" for k in range(i % 3 + 1))
        rows.append((i, "https://plain.org/a", f"<div><h1>The Site</h1><ul>{menu}</ul></div><div>We keep data.</div><div><h1>Head</h1>{body}<p>Ask us.</p></div><div>by writer {i}</div>"))
    rows += [(20 + i, "https://one.org/", "<div><p>always the same</p></div>") for i in range(5)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["row"]["page_id"]: r["out"]["text"] for r in extract_main_text(table).collect()}
    for i in range(8):
        story = " ".join(f"story {i} part {k} with words" for k in range(i % 3 + 1))
        assert got[i] == f"Head {story} by writer {i}"
    assert {got[i] for i in range(20, 25)} == {"always the same"}


def test_class_words_drop_no_main_text(spark):
    rows = []
    for i in range(6):
        text = f"<p>long enough text number {i} of the page</p>"
        rows += [
            (10 + i, "https://a.org", f"<body class='has-sidebar nav'><article>{text}</article><div class='ad'>x</div></body>"),
            (20 + i, "https://b.org", f"<body><div class='no-ads'>{text}</div><div class='header-fixed'>also {i}</div><nav>a b c</nav></body>"),
            (30 + i, "https://c.org", f"<body><form class=search>{text}</form><div>rest {i}</div></body>"),
            # Two templates on a host: neither loses its text to the other.
            (40 + i, "https://d.org", f"<body><div id=main>{text * 9}</div></body>" if i else "<body><div id=main>x</div><div id=other>mostly here</div></body>"),
        ]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["row"]["page_id"]: r["out"]["text"] for r in extract_main_text(table).collect()}
    for i in range(6):
        text = f"long enough text number {i} of the page"
        assert got[10 + i] == text
        assert got[20 + i] == f"{text} also {i}"
        assert got[30 + i] == f"{text} rest {i}"
    assert got[40] == "x mostly here"


def test_quotations(spark):
    rows = [
        (1, 0, "user", "Hello there.\n\nHow  are you?\nFine days these are."),
        (1, 1, "a", "> how are you?\n> Fine days these are.\n\nWell, thanks."),
        (1, 2, "b", "On Monday, X wrote:\n>> How are YOU? Fine days these are.\n> Well, thanks.\nGood to know."),
        (1, 3, "c", "> nobody wrote this\nNew topic"),
        (1, 4, "d", ">Hello there.\nI answer the first."),
        (2, 0, "user", "> Hello there.\nnot in this conversation"),
        (2, 1, "user", None),
        (None, 0, "user", "> x"),
        (3, 0, "user", ""),
        (3, 0, "user", ""),
    ]
    table = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, hash int")
    out = link_quotations(table).collect()
    assert len(out) == len(rows)
    got = {(r["row"]["conv_id"], r["row"]["turn"]): r["out"] for r in out}
    assert (got[1, 1]["parent_turn"], got[1, 1]["root_turn"], got[1, 1]["depth"]) == (0, 0, 1)
    assert got[1, 1]["own_text"].strip() == "Well, thanks."
    assert got[1, 2]["quote_levels"] == 2 and got[1, 2]["n_quoted"] == 2
    assert (got[1, 2]["parent_turn"], got[1, 2]["root_turn"], got[1, 2]["depth"]) == (1, 0, 2)
    assert got[1, 2]["own_text"] == "Good to know."
    assert got[1, 3]["parent_turn"] is None and got[1, 3]["root_turn"] == 3
    assert got[1, 4]["parent_turn"] == 0
    assert got[2, 0]["n_linked"] == 0 and got[2, 1]["own_text"] == ""
    plan = link_quotations(table)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert link_quotations(table.where("false")).count() == 0


def test_reply_chains_of_nested_quotes(spark):
    """Every message quotes the whole of the one it answers, with all it quoted, or its last part."""
    rng = random.Random(12)
    rows, wanted = [], {}
    for conv in range(40):
        texts, own = [], []
        for turn in range(rng.randint(2, 9)):
            new = [" ".join(rng.choice("lorem ipsum dolor sit amet".split()) for _ in range(6)) + f" {conv}.{turn}.{k}" for k in range(rng.randint(1, 4))]
            parent = rng.randrange(turn) if turn and rng.random() < 0.85 else None
            lines = []
            if parent is not None:
                head = [f"On day {turn}, somebody wrote:"] if rng.random() < 0.5 else []
                quoted = texts[parent] if rng.random() < 0.7 else own[parent][-1:]
                lines = head + [(">" if x.startswith(">") else "> ") + (x.upper() if rng.random() < 0.2 else x) for x in quoted] + [""]
            own.append([x for n in new for x in (n, "")][:-1])
            texts.append(lines + own[-1])
            above = wanted.get((conv, parent))
            wanted[conv, turn] = (parent, above[1] if above else turn, above[2] + 1 if above else 0, "\n".join(own[-1]))
            rows.append((conv, turn, "\n".join(texts[-1])))
    assert max(w[2] for w in wanted.values()) >= 4
    rng.shuffle(rows)
    out = link_quotations(spark.createDataFrame(rows, "conv_id long, turn long, text string")).collect()
    got = {(r["row"]["conv_id"], r["row"]["turn"]): r["out"] for r in out}
    assert {k: (o["parent_turn"], o["root_turn"], o["depth"], o["own_text"]) for k, o in got.items()} == wanted


def test_a_deep_quotation_does_not_hide_the_direct_parent(spark):
    first = "one one one\n\ntwo two two\n\nthree three three"
    second = "\n".join("> " + x for x in first.split("\n")) + "\n\nfour four four"
    third = "\n".join(">" + x if x.startswith(">") else "> " + x for x in second.split("\n")) + "\n\nfive"
    rows = spark.createDataFrame([(1, 0, first), (1, 1, second), (1, 2, third)], "conv_id long, turn long, text string")
    got = {r["row"]["turn"]: r["out"] for r in link_quotations(rows).collect()}
    assert (got[2]["parent_turn"], got[2]["root_turn"], got[2]["depth"]) == (1, 0, 2)
    assert got[2]["n_quoted"] == 4 and got[2]["quote_levels"] == 2


def test_pages_nested_very_deep():
    depth = 100_000
    for page in (
        "<div>" * depth + "the text" + "</div>" * depth + " after",
        "<article>" + "<b>" * depth + "the text" + "</i>" * depth + "<p>after",
        "<ul><li>" * depth + "the text<p>after",
    ):
        assert main_text(page, None) == "the text after"
        wrapper = merge(shape(read(page)), shape(read("<div><p>x</p></div>")))
        assert expression(wrapper)
        assert main_text(page, Part(wrapper, "", [])) == "the text after"


def test_class_words_take_no_paragraph_from_an_article():
    page = (
        "<body><div class='search'><p>find</p></div><article><h1>Head</h1><p class='search'>How search works.</p>"
        "<p class='links'>On links.</p><div class='share'>tweet</div><p class='advert'>buy</p><div class='comments'>"
        "<p>nice</p></div><aside>by the way</aside><ul><li class='menu'>soup</li></ul></article></body>"
    )
    assert main_text(page, None) == "Head How search works. On links. soup"
