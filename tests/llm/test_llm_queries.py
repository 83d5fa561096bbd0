import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from compare import compare, connect
from test_credentials import by_hand as spans_by_hand
from test_neardup import by_hand as classes_by_hand
from test_periods import row_by_hand as runs_by_hand
from test_periods import values as run_values
from test_repair import by_hand as repair_by_hand
from test_repair import damage_by_hand
from test_repair import values as repair_values

import corpus_pipeline
from leadpipe.llm import bpe, credentials, langid
from leadpipe.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("SELECT doc_id, text, lang, source FROM documents ORDER BY doc_id").fetchall()


@pytest.fixture(scope="module")
def bench(con):
    return con.execute("SELECT item_id, text FROM benchmark").fetchall()


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_agree_with_their_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SQL[name], SF) == ""


def rows(spark, name):
    return {r.doc_id: r for r in QUERIES[name](spark, SF).collect()}


def words(text):
    return "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()


def overlap(text, item):
    """Is there a place where at least 0.8 of the item's words, or of 13 of them, agree."""
    a, b = words(text), words(item)
    for d in range(13 - len(b), len(a) - 12):
        same = [0 <= d + i < len(a) and a[d + i] == w for i, w in enumerate(b)]
        if any(sum(same[i : i + 13]) >= 11 and all(same[i : i + 2]) for i in range(max(1, len(b) - 12))):
            return True
    return False


def contaminated(docs, bench):
    return {(i, item) for i, text, *_ in docs for item, b in bench if set(words(b)) & set(words(text)) and overlap(text, b)}


def test_op1(spark, docs, bench):
    found = QUERIES["op1_benchmark_decontamination"](spark, SF).collect()
    assert {(r.doc_id, r.item_id) for r in found} == contaminated(docs, bench)


def test_op4(spark, docs):
    found = rows(spark, "op4_language_id")
    assert {i: r.held_out for i, r in found.items()} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, *_ in docs}
    out = [(found[i].lang_pred, lang) for i, _, lang, _ in docs if found[i].held_out and lang]
    assert sum(a == b for a, b in out) >= 0.95 * len(out)


def test_op6(spark, docs):
    found = rows(spark, "op6_sentence_spans")
    assert set(found) == {i for i, *_ in docs}
    seen, left = defaultdict(set), defaultdict(set)
    for i, text, *_ in docs:
        for table, body in ((seen, text), (left, found[i].text)):
            w = body.split()
            for k in range(len(w) - 49):
                if len(set(w[k : k + 50])) > 25:
                    table[tuple(w[k : k + 50])].add(i)
    repeated = {w: min(ids) for w, ids in seen.items() if len(ids) > 1}
    assert repeated
    # Of a passage of 50 words that repeats, no second copy is left, and the first one is whole.
    assert not [w for w, ids in left.items() if len(ids) > 1]
    assert all(i in left.get(w, {i}) for w, i in repeated.items())
    # What repeats nothing is as it was.
    shared = {i for w, ids in seen.items() if len(ids) > 1 for i in ids}
    short = defaultdict(set)
    for i, text, *_ in docs:
        w = text.split()
        for k in range(len(w) - 15):
            short[tuple(w[k : k + 16])].add((i, k))
    touched = {i for places in short.values() if len(places) > 1 for i, _ in places}
    assert all(found[i].text == text for i, text, *_ in docs if i not in touched | shared)


def test_op7(spark, docs):
    found = rows(spark, "op7_secret_scans")
    for i, text, *_ in docs:
        expected = spans_by_hand(text)
        assert found[i].base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest()


def test_op8(spark, docs):
    found = {i: r.class_id for i, r in rows(spark, "op8_dart_minhash").items()}
    assert found == classes_by_hand([(i, t) for i, t, *_ in docs])


def test_op9(spark, con):
    found = rows(spark, "op9_toxicity")
    labels = con.execute("SELECT doc_id, toxic FROM labels").fetchall()
    out = [(found[i].predicted, toxic) for i, toxic in labels if found[i].held_out]
    assert sum(a == b for a, b in out) >= 0.85 * len(out)
    assert len(found) == con.execute("SELECT count(*) FROM documents").fetchone()[0]


def codec():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return bpe.encoding(file.read(), public_tokenizers.PATTERN)


def test_op10(spark, docs):
    found = rows(spark, "op10_byte_bpe")
    for i, text, *_ in docs:
        ids = np.array(codec().encode_ordinary(text or ""), "<u4")
        assert (found[i].n_tokens, found[i].ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert found[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_op11(spark, con):
    turns = con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    talks = {r[0]: [] for r in turns}
    for row in damage_by_hand(turns):
        talks[row[0]].append(row)
    found = QUERIES["op11_conversation_repair"](spark, SF).collect()
    assert {r.conv_id: repair_values(r) for r in found} == {c: repair_by_hand(rows)[0] for c, rows in talks.items()}


def test_op12(spark, docs):
    found = rows(spark, "op12_periodic_runs")
    assert len(found) == len(docs)
    for i, text, *_ in docs:
        if len((text or "").split()) <= 2000:
            assert runs_by_hand(i, text) == run_values(found[i])
    assert sum(r.n_runs > 0 for r in found.values()) > 0.05 * len(docs)


def test_op13(spark, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = rows(spark, "op13_sentencepiece")
    assert len(found) == len(docs)
    for i, text, *_ in docs:
        ids = library.encode(text or "", add_eos=True)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (found[i].n_tokens, found[i].ids_sha256) == (len(ids), digest)
        assert found[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_the_pipeline_against_plain_loops(spark, docs, bench):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    learned = langid.learn(table)
    accepted = {r.doc_id for r in langid.predict(table, learned).where("accepted").collect()}
    kept = [d for d in docs if d[0] in accepted]
    assert len(kept) > 0.95 * len(docs)
    classes = classes_by_hand([(i, t) for i, t, *_ in kept])
    kept = [d for d in kept if classes[d[0]] == d[0]]
    dirty = {i for i, _ in contaminated(kept, bench)}
    kept = [d for d in kept if d[0] not in dirty]
    owners = defaultdict(set)
    for _, text, _, source in kept:
        for s in credentials.find(text):
            owners[s["secret"]].add(source)
    expected = {}
    for i, text, *_ in kept:
        out, at = [], 0
        for s in sorted(credentials.find(text), key=lambda s: (s["from"], s["to"])):
            if len(owners[s["secret"]]) < credentials.EXAMPLE_OWNERS:
                if s["from"] >= at:
                    out += [text[at : s["from"]], credentials.REDACTED]
                at = max(at, s["to"])
        expected[i] = np.array(codec().encode_ordinary("".join(out) + text[at:]), "<u4").tobytes()
    found = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: bytes(r.tokens) for r in found} == expected
    assert all(r.decodes and r.n_tokens == len(r.tokens) // 4 for r in found)


def test_stages_take_what_others_leave(spark, edges, none):
    docs = edges.withColumn("n_chars", edges.n_words)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for some in (docs, docs.limit(0)):
            made = stage(spark, some, SF)
            assert made.columns == some.columns, name
            made.write.format("noop").mode("overwrite").save()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == 9 and last.where("NOT decodes").isEmpty()
