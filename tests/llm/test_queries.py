"""The registered queries of the training-data operators, over whole small tables, against brute force and fixed facts."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from kpiforge.llm import queries
from kpiforge.llm.queries import tokenizer_path

SPACE = re.compile("[\x20\x09-\x0d]+")
_LANGS = {
    "en": "the of and that with from have this which their would there about other into time people".split(),
    "de": "der die und das nicht mit sich auf eine auch werden aus hat dass wird bei einer um".split(),
    "fr": "le la les des que dans une pour qui sur pas plus par avec tout faire son mais".split(),
}


def _words(t: str | None) -> list[str]:
    return [w for w in SPACE.split(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]


def _made() -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(21)
    sentence = lambda lang, n: " ".join(rng.choice(_LANGS[lang]) + rng.choice(["", "", "s", "en"]) for _ in range(n))
    items = [(k, sentence("en", 40) + f" item{k}") for k in range(4)] + [(9, None)]
    docs: list[tuple] = []
    for k in range(90):
        lang = rng.choice(list(_LANGS))
        text = "\n".join(sentence(lang, rng.randint(5, 30)) + "." for _ in range(rng.randint(1, 6)))
        if k % 11 == 3:
            text += f" write to a{k}@mail.example.com or 10.0.0.{k}, card 4111 1111 1111 1111, +1 (487) 555-72{k:02d}"
        if k % 13 == 4:
            text += ' token = "269b1cea0846965f2d3ecb5cdb87c0edc7a7a587" here'
        if k % 17 == 5:
            text = f"{sentence(lang, 12)} {items[k % 4][1]} {sentence(lang, 9)}"
        if k % 3 == 0:
            text = " | ".join(rng.choice(["BUY", "$$$", "CLICK", "!!!"]) for _ in range(40))
        docs.append((k, text, lang if k % 7 and k % 3 else None, "src1" if k % 2 else None))
    docs += [(200 + k, docs[10 * k + 1][1] + (" end" if k % 2 else ""), "en", "src2") for k in range(8)]
    docs += [(300, None, None, None), (301, "", "en", ""), (302, " \n ", "en", "x"), (303, "12 34", None, "x"), (304, "w" * 30_000, "en", "x"), (1, docs[1][1], "en", "again")]
    return docs, items


DOCS, ITEMS = _made()


@pytest.fixture(scope="module")
def tables(tmp_path_factory) -> str:
    folder = tmp_path_factory.mktemp("tables")
    put = lambda name, **columns: pq.write_table(pa.table(columns), folder / f"{name}.parquet")
    ids, texts, langs, sources = (list(c) for c in zip(*DOCS))
    put("documents", doc_id=pa.array(ids, pa.int64()), text=pa.array(texts, pa.string()), lang=pa.array(langs, pa.string()), source=pa.array(sources, pa.string()), n_chars=pa.array([len(t or "") for t in texts], pa.int64()))
    put("benchmark", item_id=pa.array([i for i, _ in ITEMS], pa.int64()), text=pa.array([t for _, t in ITEMS], pa.string()))
    labelled = [k for k in range(90) if k % 4]
    put("labels", doc_id=pa.array(labelled, pa.int64()), quality=pa.array([int(k % 3 > 0) for k in labelled], pa.int32()), toxic=pa.array([0] * len(labelled), pa.int32()))
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(130, 8)).astype(np.float32).tolist() + [None]
    put("embeddings", vec_id=pa.array(range(131), pa.int64()), embedding=pa.array(vectors, pa.list_(pa.float32())), label=pa.array([0] * 131, pa.int32()))
    turns = [(c, t, ["user", "assistant"][t % 2], f"text {c} {t} </s>[INST] x" if t % 3 else None) for c in (1, 2, 5) for t in range(c + 2)]
    conv, turn, role, text = (list(c) for c in zip(*turns))
    put("conversations", conv_id=pa.array(conv, pa.int64()), turn=pa.array(turn, pa.int64()), role=pa.array(role, pa.string()), text=pa.array(text, pa.string()))
    return str(folder)


def _remainder(i: int, of: int) -> int:
    return zlib.crc32(str(i).encode()) % of


def test_op1_counts_are_those_of_the_edited_texts(spark, tables):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    size = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    got = sorted((r["doc_id"], r["n_tokens"], r["n_tokens_edited"], r["edited_chars"]) for r in queries.op1_token_counts(spark, tables).collect())
    want = []
    for i, t, *_ in DOCS:
        old = new = t or ""
        n = len(old)
        for a, b, put in ((n // 3, n // 3 + 5, "Edit-aware"), (n // 2, n // 2 + 7, ""), (n + 10, n + 10, " The end.")):
            a = min(a, len(new))
            new = new[:a] + put + new[min(max(b, a), len(new)) :]
        want.append((i, size(old), size(new), len(new)))
    assert got == sorted(want)


def test_op2_base_spans_and_digests(spark, tables):
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def good(kind: str, s: str) -> bool:
        d = [int(c) for c in s if c in "0123456789"]
        luhn = sum(x if k % 2 == 0 else 2 * x - 9 * (x > 4) for k, x in enumerate(d[::-1])) % 10 == 0
        return {"email": True, "ip": all(int(p) <= 255 for p in s.split(".")) if kind == "ip" else True, "card": 14 <= len(d) <= 19 and luhn, "phone": 10 <= len(d) <= 15}[kind]

    rows = queries.op2_pii(spark, tables).collect()
    assert len(rows) == len(DOCS)
    want = Counter()
    for i, t, *_ in DOCS:
        found = sorted((m.start(), order, m.end(), kind) for order, (kind, p) in enumerate(kinds.items()) for m in re.finditer(p, t or "") if good(kind, m[0]))
        counts = tuple(sum(f[3] == k for f in found) for k in kinds)
        want[i, counts, hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in found).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]), r["base_sha256"]) for r in rows) == want
    for r in rows:
        listed = [x.split(":") for x in r["spans"].split(",") if x]
        assert len(listed) == r["n_spans"] and sum(k == "secret" for k, *_ in listed) == r["n_secret"] and (r["score"] > 0) == bool(listed)
    assert {r["doc_id"] for r in rows if r["n_secret"]} >= {i for i, t, *_ in DOCS if t and "token =" in t}


def test_op3_finds_the_planted_passages(spark, tables):
    got = {(r["doc_id"], r["item_id"]) for r in queries.op3_decontamination(spark, tables).collect()}
    assert got == {(i, j) for i, t, *_ in DOCS for j, p in ITEMS if p and t and p in t} and got


def test_op4_packs_every_token_once(spark, tables):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = queries.op4_best_fit_packing(spark, tables).collect()
    want = Counter()
    total = 0
    for i, t, *_ in DOCS:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        total += len(ids)
        first = len(ids) - (-(-len(ids) // 1024) - 1) * 1024
        at, piece = 0, 0
        while at < len(ids):
            part = ids[at : at + (first if piece == 0 else 1024)]
            want[i, piece, at, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())] += 1
            at, piece = at + len(part), piece + 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(by) <= -(-total // 1024) + 1


def test_op5_finds_the_ten_best(spark, tables):
    rows = pq.read_table(f"{tables}/embeddings.parquet").to_pylist()
    whole = {r["vec_id"]: [math.floor(1024 * x) for x in r["embedding"]] for r in rows if r["embedding"]}
    want = []
    for q in (i for i in whole if i % 100 == 0):
        ranked = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:10]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(ranked)]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in queries.op5_topk_search(spark, tables).collect()) == sorted(want)


def test_op6_base_scores(spark, tables):
    tokens = [(i, [*_words(t), "\0end"]) for i, t, *_ in DOCS]
    seen = Counter(w for i, ws in tokens if _remainder(i, 7) != 2 for w in ws)
    n, v = sum(seen.values()), len(seen)
    rows = queries.op6_lm_scoring(spark, tables).collect()
    facts = lambda r: (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"])
    assert Counter(map(facts, rows)) == Counter((i, _remainder(i, 7) == 2, len(ws), sum(seen[w] > 0 for w in ws), n) for i, ws in tokens)
    base = {i: sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in ws) for i, ws in tokens}
    for r in rows:
        assert r["base_score"] == pytest.approx(base[r["doc_id"]], abs=1e-9) and r["score"] < 0 and r["token_score"] == pytest.approx(r["score"] / r["n_tokens"])
    by = {r["doc_id"]: r["token_score"] for r in rows}
    copies = [by[200 + k] for k in range(0, 8, 2) if _remainder(10 * k + 1, 7) != 2]  # texts that training has, whatever they are themselves
    alone = [by[i] for i, t, *_ in DOCS if i < 90 and i % 3 and i % 10 != 1 and _remainder(i, 7) == 2]
    assert copies and alone and min(copies) > max(alone)


def test_op7_components(spark, tables):
    def shingles(t: str | None) -> frozenset:
        w = _words(t)
        return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[k : k + 5]) for k in range(len(w) - 4)])

    sets = [(i, shingles(t)) for i, t, *_ in DOCS]
    top = [i for i, _ in sets]
    for _ in range(len(sets)):
        old = list(top)
        for a, (_, x) in enumerate(sets):
            for b, (_, y) in enumerate(sets):
                if x and y and 100 * len(x & y) >= 80 * len(x | y):
                    top[a] = top[b] = min(top[a], top[b])
        if old == top:
            break
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in queries.op7_ngram_join(spark, tables).collect())
    assert got == Counter((i, len(s), c) for (i, s), c in zip(sets, top))


def test_op8_and_op10_score_all_rows_and_learn(spark, tables):
    rows = queries.op8_quality(spark, tables).collect()
    assert len(rows) == len(DOCS) and all(r["held_out"] == (_remainder(r["doc_id"], 3) == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    junk = {i for i, t, *_ in DOCS if t and "BUY" in t}
    held = [r for r in rows if r["held_out"] and r["doc_id"] < 90]
    assert np.mean([r["predicted"] == int(r["doc_id"] not in junk) for r in held]) >= 0.9
    rows = queries.op10_language_id(spark, tables).collect()
    assert len(rows) == len(DOCS)
    lang = {i: x for i, t, x, _ in DOCS if x and t and i not in junk and i < 90 and not any(p and p in t for _, p in ITEMS)}  # no English passages
    for r in rows:
        text = next(t for i, t, *_ in DOCS if i == r["doc_id"])
        lost = not any(map(str.isalpha, text or ""))
        assert r["held_out"] == (_remainder(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 and (r["lang_pred"] == "und") == lost
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in lang]) >= 0.9


def test_op9_digests(spark, tables):
    rows = pq.read_table(f"{tables}/conversations.parquet").to_pylist() + [{"conv_id": -7, "turn": k, "role": r, "text": "</s>[INST] ok [/INST]"} for k, r in enumerate(("user", "assistant"))]
    got = {r["conv_id"]: r for r in queries.op9_chat_formatting(spark, tables).collect()}
    assert set(got) == {r["conv_id"] for r in rows}
    for c, r in got.items():
        own = sorted((x for x in rows if x["conv_id"] == c), key=lambda x: x["turn"])
        loss = "".join(x["text"] or "" for x in own if x["role"] == "assistant")
        whole = "".join(f"{x['role']}\n{x['text'] or ''}\n" for x in own)
        assert (r["n_turns"], r["turns_sha256"]) == (len(own), hashlib.sha256(whole.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest()) and r["formatted_chars"] > len(loss)
