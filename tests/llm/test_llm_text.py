"""Token counts and SentencePiece against their libraries, secret scan, languages, decontamination, surrogates."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from larder.llm import decontamination, language_id, pieces, queries, secret_scan, surrogates, token_counts

FOLDER = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n\n", "a" * 3000, " " * 50, "the " * 500, "x're 'll\n've", "<|endoftext|>a <|endoftext|>", "▁▁ x", "\x00\x1c\x85",
       "漢字かな交じり文", "😀😀 ñ", "-" * 777, "aaaaaab" * 50]
BPE, MODEL = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def noise(count, seed=1):
    rng = random.Random(seed)
    letters = list("aabb  's'srelltdm'' \n\t1299.,!-éßñ漢字😀  \x1cⅣ²▁")
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(count)]


@pytest.fixture(scope="module")
def texts(spark):
    real = [r[0] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").collect()]
    return ODD + noise(1500) + real


def test_token_counts_equal_the_library(spark, texts):
    table = spark.createDataFrame([(k, t, "n") for k, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    library = Tokenizer.from_file(BPE)
    got = sorted(tuple(r) for r in token_counts.count_tokens(table, BPE).collect())
    counts = [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert got == [(k, len((t or "").encode()), n, n > 512) for k, (t, n) in enumerate(zip(texts, counts))]
    assert token_counts.count_tokens(table.limit(0), BPE).collect() == []


def test_pieces_equal_the_library_and_decode_back(spark, texts):
    table = spark.createDataFrame([(k, t, 7) for k, t in enumerate(texts)], "doc_id long, text string, decoded int")
    both = pieces.decode_pieces(pieces.encode_pieces(table, MODEL), MODEL).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert sorted((r.doc_id, r.piece_ids) for r in both) == list(enumerate(library.encode([t or "" for t in texts])))
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in both)
    assert pieces.round_trip(table, MODEL).filter("NOT same").count() == 0
    assert pieces.encode_pieces(table.limit(0), MODEL).collect() == []
    ids = spark.createDataFrame([([1, 2, None, 40000, -1, 5 + 3 + 0xFF],), (None,), ([],)], "piece_ids array<int>")
    assert [r.decoded for r in pieces.decode_pieces(ids, MODEL).collect()][1:] == [None, ""]


def test_pieces_are_encoded_and_decoded_by_one_worker(spark, texts):
    table = spark.createDataFrame([(k, t, 7) for k, t in enumerate(texts)], "doc_id long, text string, decoded int")
    both = pieces.encode_and_decode(table, MODEL)
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, pieces.decode_pieces(pieces.encode_pieces(table, MODEL), MODEL).collect()))
    for frame in (both, pieces.round_trip(table, MODEL)):
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def base_of(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
    found = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in assign.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [x[2] for x in sorted(found)]


def test_secret_scan_keeps_the_base_spans(spark, tmp_path):
    rng = random.Random(4)
    parts = ["password", "TOKEN", "api_key", "apikey", ' = "', ": ", "=", "'", "AKIA", "ABCDEFGH12345678", "deadbeef00112233", "secret",
             "\n", " ", "é", "x", "aKIA", "0123456789abcdef", "==", "ſecret"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(800)]
    rows = [(k, t) for k, t in enumerate([None, "", *made])]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    for r in queries.op2_secret_scan(spark, folder).collect():
        want = base_of(rows[r.doc_id][1] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex")]
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if s.split(":")[0] in ("assign", "access", "hex")] == want
        assert len(spans) == len(want) + r.n_lexed


@pytest.mark.parametrize("text, found", [
    ('db_password = "s3cr3t-Pa55phrase!"', ["s3cr3t-Pa55phrase!"]), ('{"clientSecret": "Zx81-qq-77-Ab"}', ["Zx81-qq-77-Ab"]),
    ('base = "Kx9_77hQ2zz1"\nother = 1\nconfig.auth_token = base', ["Kx9_77hQ2zz1"]),
    ('a = "Kx9_77"\nb = "hQ2zz1AA"\nsecret_key := a + b', ["Kx9_77", "hQ2zz1AA"]), ("export API_KEY=Abc123Def456", ["Abc123Def456"]),
    ('os.environ["PASSWD"] = \'Qw3rty!uiop9\'', ["Qw3rty!uiop9"]), ('token_count = "Kx9_77hQ2zz1"', []), ('password = "${PASSWORD}"', []),
    ("password: changeme", []), ('title = "Kx9_77hQ2zz1"', []), ('public_key = "Kx9_77hQ2zz1"', []), ("", []), ("secret = ", []),
    ('# password = "Kx9_77hQ2zz1"', ["Kx9_77hQ2zz1"])])
def test_lexing_scores_literals_by_the_name_they_reach(text, found):
    assert [text[s:e] for s, _, e in sorted(secret_scan.lexed_spans(text, 0.5))] == found


def test_scan_finds_quoted_called_and_declared_names(spark):
    texts = ["`db_password`: 'Kx9_77hQ2zz1'", "cfg[`auth_token`] = 'Kx9_77hQ2zz1'", "env('PASSWORD') = 'Kx9_77hQ2zz1'",
             'password: str = "Kx9_77hQ2zz1"', 'const apiToken: string = "Kx9_77hQ2zz1"', 'title: str = "Kx9_77hQ2zz1"']
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [texts[r.doc_id][x.start:x.end] for x in r.lexed] for r in secret_scan.scan_secrets(table).collect()}
    assert found == {**{k: ["Kx9_77hQ2zz1"] for k in range(5)}, 5: []}


def test_languages_are_told_apart_on_held_out_documents(spark):
    folder = FOLDER.replace("0.001", "0.01")
    found = queries.op1_language_id(spark, folder)
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", F.col("lang").alias("truth"))
    rows = found.join(truth, "doc_id").filter("held_out").collect()
    assert len(rows) > 150 and sum(r.lang_pred == r.truth for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_texts_and_models_without_rows(spark, rows):
    table = spark.createDataFrame([(1, None), (2, ""), (3, "12 !!"), (None, "the of and"), (5, "x " * 100000)], "doc_id long, text string")
    assert {r[1] for r in rows(language_id.identify_languages(table, None))} == {"und"}
    one = spark.createDataFrame([("a b c", "en"), ("nothing", None)], "text string, lang string")
    model = language_id.fit_language_model(one)
    found = dict(rows(language_id.identify_languages(table, model), "doc_id", "lang_pred"))
    assert found == {1: "und", 2: "und", 3: "und", None: "en", 5: "en"}
    assert language_id.fit_language_model(one.limit(0)) is None
    assert rows(language_id.keep_identified(table, model), "doc_id") == [(5,), (None,)]
    assert language_id.family_of("pt-BR") == "romance" and language_id.family_of("xx") == "xx"


def plain_tiles(test, text, least):
    """Greedy string tiling, one match at a time."""
    free_a, free_b, covered = [True] * len(test), [True] * len(text), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(test)):
            for j in range(len(text)):
                n = 0
                while i + n < len(test) and j + n < len(text) and free_a[i + n] and free_b[j + n] and test[i + n] == text[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return covered
        n, i, j = best
        free_a[i:i + n] = free_b[j:j + n] = [False] * n
        covered += n


def test_greedy_tiles_cover_as_much_as_the_plain_algorithm():
    rng = random.Random(8)
    for _ in range(150):
        a = np.array([rng.randrange(3) for _ in range(rng.randint(1, 25))], np.uint64)
        b = np.array([rng.randrange(3) for _ in range(rng.randint(1, 40))], np.uint64)
        tiles = decontamination.greedy_tiles(a, b, 3)
        for i, j, n in tiles:
            assert (a[i:i + n] == b[j:j + n]).all() and n >= 3
        for side in (0, 1):
            spots = [t[side] + k for t in tiles for k in range(t[2])]
            assert len(spots) == len(set(spots))
        assert sum(n for _, _, n in tiles) == plain_tiles(a.tolist(), b.tolist(), 3)


def test_reordered_and_partial_passages(spark, rows, monkeypatch):
    words = [f"w{k}" for k in range(40)]
    test = " ".join(words)
    docs = [(1, "start " + " ".join(words[20:] + ["between"] + words[:20]) + " end"), (2, " ".join(words[:18])), (3, test.upper().replace(" ", ", ")),
            (4, None), (5, ""), (6, "two words"), (None, test), (8, " ".join(words[::2])), (9, ("w0 w1 w2 w3 w4 " * 5000)), (10, "short one, really")]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, coverage int")
    bench = spark.createDataFrame([(1, test), (2, None), (3, ""), (4, "Short one")], "item_id long, text string")
    for size in (16 << 20, 100):
        monkeypatch.setattr(decontamination, "BLOCK_BYTES", size)
        found = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(frame, bench).collect()}
        assert set(found) == {(1, 1), (3, 1), (None, 1), (10, 4)}
        assert found[1, 1].n_tiles == 2 and found[1, 1].coverage == 1.0
        assert [tuple(t) for t in found[1, 1].tiles] == [(0, 22, 20), (20, 1, 20)]
        assert rows(decontamination.keep_uncontaminated(frame, bench), "doc_id") == [(2,), (4,), (5,), (6,), (8,), (9,)]
    assert decontamination.contaminated(frame, bench.limit(0)).collect() == []
    assert decontamination.contaminated(frame.limit(0), bench).collect() == []


def test_coverage_of_documents_equals_plain_tiling(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    got = sorted((r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).collect())
    split = lambda t: re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", t.lower())
    tests = [(r.item_id, split(r.text)) for r in bench.collect()]
    want = []
    for doc, text in docs.select("doc_id", "text").collect():
        words = split(text or "")
        grams = {tuple(words[k:k + 5]) for k in range(len(words))}
        for item, test in tests:
            if any(tuple(test[k:k + 5]) in grams for k in range(len(test))) and plain_tiles(test, words, 5) >= 0.5 * len(test):
                want.append((doc, item))
    assert got == sorted(want) and got


def test_mentions_and_their_formats():
    text = ("Mail that.92@mail2.example.com or +1 (323) 555-9830, (323) 555-9830; card 4111 1111 1111 1111 ip 70.123.182.155. "
            "Mrs. Anna Smith met Herr MÜLLER; г-жа Иванова; 10.0.0.1 v4.0.1 1.2.3.400 nora Nora Jones.")
    found = surrogates.mentions(text)
    assert [(m.kind, m.canon) for m in found] == [
        ("email", "that.92@mail2.example.com"), ("phone", "3235559830"), ("phone", "3235559830"), ("card", "4" + "1" * 15),
        ("ip", "70.123.182.155"), ("given", "anna"), ("surname", "smith"), ("surname", "müller"), ("surname", "иванова"), ("ip", "10.0.0.1"),
        ("given", "nora"), ("surname", "jones")]
    new = {m: surrogates.surrogate(b"k", m.kind, m.canon, m.traits, 0) for m in found}
    shown = [surrogates.rendered(text[m.start:m.end], m.kind, new[m]) for m in found]
    shape = lambda t: re.sub(r"[^\W\d_]", "a", re.sub(r"\d", "9", t))
    for m, s in list(zip(found, shown))[:4]:
        assert shape(s) == shape(text[m.start:m.end]) and s != text[m.start:m.end]
    assert shown[1] == "+1 " + shown[2] and surrogates.luhn(new[found[3]]) and shown[7].isupper()
    assert new[found[5]] in surrogates.GIVEN["latin", "f"].casefold() and new[found[8]].endswith("ова") and shown[9].startswith("10.")


def test_surrogates_are_distinct_and_consistent(spark, rows):
    many = [f"mail a{k}@b.co and " + ("Frau Anna Berg" if k % 2 else "frau anna berg; Frau BERG") + f" at 10.1.2.{k}" for k in range(256)]
    table = spark.createDataFrame([(k, t, "c") for k, t in enumerate([None, "", "nothing", *many, many[0]])], "doc_id long, text string, canon string")
    out = {r.doc_id: r for r in surrogates.replace_entities(table, b"key").collect()}
    assert len(out) == 260 and out[0].text is None and (out[1].text, out[2].text) == ("", "nothing") and out[2].n_entities == 0
    texts = [out[k].text for k in range(3, 259)]
    assert out[259].text == texts[0] and out[3].canon == "c"
    mails = {re.search(r"\S+@\S+", t)[0] for t in texts}
    assert len(mails) == 256 and not mails & {f"a{k}@b.co" for k in range(256)}
    assert len({t.rpartition(" ")[2] for t in texts}) == 256
    names = {re.search(r"Frau (\S+) (\S+) at", t).groups() for t in texts if re.search(r"Frau (\S+) (\S+) at", t)}
    assert len(names) == 1
    upper = {re.search(r"Frau (\S+) at", t)[1] for t in texts if "; Frau" in t}
    assert upper == {next(iter(names))[1].upper()}
    again = {r.doc_id: r.text for r in surrogates.replace_entities(table, b"key").collect()}
    other = {r.doc_id: r.text for r in surrogates.replace_entities(table, b"other").collect()}
    assert again == {k: r.text for k, r in out.items()} and other != again
    assert surrogates.replace_entities(table.limit(0), b"key").collect() == []


def test_names_after_cyrillic_and_greek_titles_alone_are_replaced(spark):
    texts = ["здесь господин Кузнецов", "г-н Кузнецов", "ГОСПОЖА Кузнецова", "г-жа Иванова", "κύριος Παππάς", "ΚΎΡΙΟΣ Παππάς", "η κυρία Παπαδοπούλου", "Herr Schmidt"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in surrogates.replace_entities(table, b"key").collect()}
    for k, text in enumerate(texts):
        assert out[k].n_entities == len(surrogates.mentions(text)) == 1 and text.split(" ")[-1] not in out[k].text
    assert out[0].text.split(" ")[-1] == out[1].text.split(" ")[-1]


def test_no_personal_data_of_the_documents_is_left(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = {m.canon for r in docs.collect() for m in surrogates.mentions(r.text or "")}
    out = surrogates.replace_entities(docs, b"key")
    after = {m.canon for r in out.collect() for m in surrogates.mentions(r.text or "")}
    assert before and out.columns == [*docs.columns, "n_entities"] and not before & after and len(before) == len(after)


def test_arrow_slices_hold_whole_rows():
    from larder.llm.arrow import slices
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 50, "", "c"]})
    assert [p.num_rows for p in slices(iter([batch]), "text", 20)] == [2, 1, 2]


def test_constants_that_double_take_no_time_and_types_are_stepped_over():
    lines = ["x0 = 'Kx9_77hQ2zz1'"] + [f"x{k} = x{k - 1} + x{k - 1}" for k in range(1, 60)] + ["password = x59"]
    text = "\n".join(lines)
    assert [(text[s:e], kind) for s, kind, e in secret_scan.lexed_spans(text, 0.5)] == [("Kx9_77hQ2zz1", "constant")]
    grown = "s = 'a8F$'\n" + "s = s + 'q7'\n" * 20_000 + "token = s"
    assert len(secret_scan.lexed_spans(grown, 0.0)) >= 1
    for typed in ("password: Optional[str] = 'Kx9_77hQ2zz1'", "password: dict[str, list[int]] | None = 'Kx9_77hQ2zz1'", "const apiToken: string = 'Kx9_77hQ2zz1'"):
        assert [typed[s:e] for s, _, e in secret_scan.lexed_spans(typed, 0.5)] == ["Kx9_77hQ2zz1"]


def test_crowded_spaces_are_permuted(spark):
    """40,000 of the 65,536 addresses of 192.168/16 leave too few others; phones and mail of the same corpus are drawn."""
    rows = [("ip", f"192.168.{k >> 8}.{k & 255}", "192.168") for k in range(40000)] + [("ip", "8.8.4.4", "public"), ("phone", "+49 30123", "")]
    out = surrogates.assign_surrogates(spark.createDataFrame(rows, "kind string, canon string, traits string"), b"k").collect()
    new = {(r.kind, r.canon): r.surrogate for r in out}
    assert len(out) == len(new) == len(rows) and len(set(new.values())) == len(rows)
    assert all(new["ip", c].startswith("192.168.") for k, c, t in rows if t == "192.168")
    assert new["ip", "8.8.4.4"] == surrogates.surrogate(b"k", "ip", "8.8.4.4", "public", 0) and new["phone", "+49 30123"].startswith("+49 ")


@pytest.mark.parametrize("kind,traits,canons", [
    ("phone", "", [f"+7 {n}" for n in range(200, 1000)]), ("phone", "", [f"{n:03d}" for n in range(200)]),
    ("card", "luhn", [c for n in range(1000) if surrogates.luhn(c := f"4{n:03d}")]),
    ("card", "", [c for n in range(1000) if not surrogates.luhn(c := f"4{n:03d}")])])
def test_a_permutation_covers_its_space(kind, traits, canons):
    new = [surrogates.permuted_surrogate(b"k", kind, c, traits) for c in canons]
    assert sorted(new) == sorted(canons) and new != canons
    assert len({surrogates.space_of(kind, c, traits) for c in canons}) == 1


def test_public_addresses_stay_public():
    new = {surrogates.permuted_surrogate(b"k", "ip", f"{a}.0.0.{b}", "public") for a in (8, 9, 11, 172, 192) for b in range(50)}
    assert len(new) == 250 and not any(surrogates.mentions(x)[0].traits != "public" for x in new)


def test_names_with_hyphen_and_apostrophe():
    words = lambda text: [text[m.start:m.end] for m in surrogates.mentions(text)]
    assert words("Mr. Smith-Jones met Dr O'Neill and Anna D'Arcy-Lee's dog") == ["Smith-Jones", "O'Neill", "Anna", "D'Arcy-Lee"]
    assert words("Mrs Smith's house") == ["Smith"]
