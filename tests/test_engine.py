"""The engine: golden rows, DuckDB SQL side by side, rules against an independent plain-Python version."""

import json
import random
import re
import unicodedata

import duckdb
import pytest
from pyspark.sql import functions as F

from pagelore import cli, config
from pagelore.functions import correction as C
from pagelore.functions import lexicon as V
from pagelore.functions import models, spans, text
from pagelore.operators import chapters, corpus, correction, numbering, toc
from pagelore.plans import queries as Q
from pagelore.sinks import writers
from pagelore.sources import cache, pdf
from pagelore.streaming import incremental

SF = "/root/testdata/sf0.001"
SMALL = ["tone_fixes", "nfc", "blocks", "chunk_fixtures", "length_guard", "rule_entities", "entity_records", "model_and_rules", "page_ranges", "span_resolution", "bio_merge", "content_range", "chapter_codes", "sentence_ids", "page_texts", "numbers", "first_sentences", "cache_join"]


def rows(names, data):
    return sorted(str(tuple(r[names.index(n)] for n in sorted(names))) for r in data)


@pytest.mark.parametrize("name", SMALL)
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = Q.QUERIES[name](spark, SF), con.execute(Q.SQL[name])
    assert rows(got.columns, got.collect()) == rows([d[0] for d in want.description], want.fetchall())


def test_page_text(spark):
    own = spark.createDataFrame([(Q.PAGES[0][1],), (Q.PAGES[2][1],), (None,), ("",)], "t string")
    got = [r.x for r in own.select(text.page_text(F.col("t")).alias("x")).collect()]
    assert got == ["Vua Lê Lợi lên ngôi. Năm ấy dựng chươngtrình mới", "tr.290 G. S. ngôi. Năm", "", ""]


def python_pattern(java):
    out = java.replace(r"[\p{L}\p{N}_]", r"(?:\w)").replace("(?<own>", "(?P<own>").replace("(?<lead>", "(?P<lead>")
    return re.compile(out.replace("(?<!(?:\\w))", r"(?<!\w)").replace("(?!(?:\\w))", r"(?!\w)"))


def test_rules_differ_nowhere_from_re(spark):
    rng = random.Random(4)
    bits = ["năm", "Năm", "tháng", "ngày 2", "đời", "vua", "Vua", "chúa", "nhà", "triều", "Lê Lợi", "Lê", "Thái-Tổ", "Hồng Đức", "thứ 2", "1428", "179 TCN", "sông", "tỉnh", "kinh thành", "Thăng Long", "Thăng-long", "Viện Sử học", "12/3/1970", "3 vạn", "2.000 người", "mùa xuân", "giờ Tý", "thế kỷ XV", "thời kỳ", "đá mới", "quan lang", "họ", "Giáp Tý", "cầu", ",", ".", "-", "x", "đvua"]
    sentences = [" ".join(rng.choice(bits) for _ in range(rng.randint(1, 9))) for _ in range(300)]
    own = spark.createDataFrame([(s,) for s in sentences], "s string").select("s", spans.rule_spans(F.col("s")).alias("x"))
    for r in own.collect():
        want = []
        for seq, (label, pattern) in enumerate(V.rules(), 1):
            for m in python_pattern(pattern).finditer(r.s):
                want.append((*(m.span("own") if "own" in m.re.groupindex else m.span()), V.PRIORITY[label], seq, label))
        assert [tuple(x) for x in r.x] == want, r.s


def test_numbering_over_runs(spark, monkeypatch):
    monkeypatch.setattr(numbering, "RUN", 3)
    pages = spark.createDataFrame([(w, p, [f"{w}{p}{i}" for i in range(p % 4)]) for w in "ab" for p in range(12)], "w string, p long, items array<string>")
    got = numbering.explode_numbered(pages, "w", "p", "items", "item").orderBy("w", "seq").collect()
    for w in "ab":
        own = [r for r in got if r.w == w]
        assert [r.seq for r in own] == list(range(1, 19)) and [r.item for r in own] == [f"{w}{p}{i}" for p in range(12) for i in range(p % 4)]


class Fake:
    def __init__(self, replies=None, fail=0):
        self.replies, self.fail, self.calls = replies or {}, fail, 0

    def generate(self, prompt, model):
        self.calls += 1
        if self.calls <= self.fail:
            raise OSError("down")
        return next((v for k, v in self.replies.items() if k in prompt), prompt)


def test_retry_and_throttle():
    slept = []
    assert correction.with_retry(Fake({"a": "ok"}, fail=1), "a", "m", sleep=slept.append) == "ok" and slept == [1]
    slept.clear()
    with pytest.raises(OSError):
        correction.with_retry(Fake(fail=9), "a", "m", sleep=slept.append)
    assert slept == [1, 2]
    waits = []
    throttle = correction.Throttle(60, 2, clock=lambda: 0.0, sleep=waits.append)
    throttle.wait(), throttle.wait(), throttle.wait()
    assert waits == [2.0, 4.0]


def test_correction_run(spark, tmp_path):
    pages = spark.createDataFrame([("w", 1, ["Vỉệt Nam"]), ("w", 2, ["Vỉệt Nam"]), ("w", 3, ["boom"]), ("w", 4, ["abcdefghij"])], "chap_code string, page_no long, blocks array<string>")

    class Client:
        def generate(self, prompt, model):
            chunk = prompt[len(V.PROMPT) :]
            if chunk == "boom":
                raise OSError
            return {"Vỉệt Nam": "Việt Nam"}.get(chunk, "x")

    fixed, done = correction.correct(pages, Client, "m")
    assert [(r.page_no, r.corrected, r.action) for r in done.orderBy("page_no").collect()] == [(1, "Việt Nam", "corrected"), (2, "Việt Nam", "cache_hit"), (3, "boom", "fallback_error"), (4, "abcdefghij", "kept_original_length_guard")]
    assert {r.page_no: r.blocks for r in fixed.collect()}[1] == ["Việt Nam"]
    kept = correction.new_entries(done)
    path = str(tmp_path / "sub" / "cache.json")
    cache.save_json(kept, path)
    assert len(json.load(open(path, encoding="utf-8"))) == 2
    again = correction.correct(pages, Client, "m", cache.load_json(spark, path))[1]
    assert {r.page_no: r.action for r in again.collect()} == {1: "cache_hit", 2: "cache_hit", 3: "fallback_error", 4: "cache_hit"}


def test_cache_files(spark, tmp_path):
    assert cache.load_json(spark, str(tmp_path / "none.json")).collect() == []
    (tmp_path / "bad.json").write_text("{not json")
    assert cache.load_json(spark, str(tmp_path / "bad.json")).collect() == []


def test_prompt_and_key(spark):
    r = spark.range(1).select(C.prompt(F.lit("Vỉệt Nam")).alias("p"), C.cache_key("a", F.lit("abc")).alias("a"), C.cache_key("b", F.lit("abc")).alias("b")).first()
    assert r.p.endswith("Vỉệt Nam") and "OCR" in r.p and r.a != r.b and len(r.a) == 64


def test_pages_and_toc_by_reader(spark, tmp_path):
    for code, name in (("A", "t_1.pdf"), ("A", "t_2.pdf"), ("B", "b.pdf")):
        (tmp_path / code).mkdir(exist_ok=True)
        (tmp_path / code / name).write_text(f"{name} one|two|three")

    class Reader:
        def toc(self, content):
            return 3, [(1, "Chương 1", 2)]

        def pages(self, content, start, end):
            parts = content.decode().split("|")
            for no in range(start, min(end or 3, 3) + 1):
                yield no, parts[no - 1]

    works = chapters.chapter_numbers(pdf.folder_scan(spark, str(tmp_path)))
    assert sorted(r.chap_code for r in works.collect()) == ["A_01", "A_02", "B"]
    marks = pdf.read_toc(works, str(tmp_path), Reader)
    ranges = toc.content_range(marks.groupBy("chap_code").agg(F.max("total").alias("total")), marks)
    got = pdf.read_pages(works.join(ranges, "chap_code"), str(tmp_path), Reader).collect()
    assert sorted((r.chap_code, r.page_no, r.raw) for r in got) == [(c, n, x) for c in ("A_01", "A_02", "B") for n, x in ((2, "two"), (3, "three"))]


def test_export_and_stream(spark, tmp_path):
    pages = spark.createDataFrame([("w", 1, "Năm 1428, vua Lê Lợi lên ngôi. Câu hai \"ở đây\".")], "chap_code string, page_no long, raw string")
    ner = corpus.entities(corpus.sentences(corpus.normalize(pages)))
    writers.export_work(ner, str(tmp_path / "o"), "w", "w")
    assert (tmp_path / "o/w/w_seg.tsv").read_text().splitlines()[1] == 'w_000002\tCâu hai "ở đây".'
    assert json.loads((tmp_path / "o/w/w_ner.json").read_text())[0]["entities"][0] == {"text": "Năm 1428", "label": "TME"}
    pages.write.parquet(str(tmp_path / "in"))
    incremental.run_available(incremental.page_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_config():
    c = config.parse(["--limit", "5", "--ocr", "--pdf", "a.pdf"])
    assert (c.limit, c.ocr, c.pdf, c.correct) == (5, True, "a.pdf", False)
    with pytest.raises(SystemExit):
        config.api_key(config.RunConfig(correct=True), {})


def test_letters():
    assert unicodedata.normalize("NFC", V.LOWER) == V.LOWER and len(V.ACCENTED) == 67


def test_null_and_repeated_places_are_numbered(spark, monkeypatch):
    monkeypatch.setattr(numbering, "RUN", 3)
    rows = [("w", 9, ["c"]), ("w", 1, ["a", "b"]), ("w", None, ["n"]), ("w", None, ["n"]), (None, 4, ["x", "y"]), (None, None, ["z"]), ("w", 9, ["c"]), ("v", 2, []), ("v", 5, None), ("v", 7, ["q"])]
    got = numbering.explode_numbered(spark.createDataFrame(rows, "w string, p long, items array<string>"), "w", "p", "items", "item").collect()
    by = {w: [(r.seq, r.item) for r in sorted((r for r in got if r.w == w), key=lambda r: r.seq)] for w in ("w", None, "v")}
    assert by == {"w": [(1, "a"), (2, "b"), (3, "c"), (4, "c"), (5, "n"), (6, "n")], None: [(1, "x"), (2, "y"), (3, "z")], "v": [(1, "q")]}


def test_tones(spark):
    cases = {"hoàô": "hòaô", "hoàớ": "hòaớ", "hoào": "hoào", "toàn": "toàn", "hoà bình": "hòa bình", "ngoaì": "ngoaì", "khoẻ": "khỏe", "quỳ": "quỳ"}
    own = spark.createDataFrame([(k,) for k in cases], "t string").select("t", text.fix_tones(F.col("t")).alias("x"))
    assert {r.t: r.x for r in own.collect()} == cases


def test_gazetteer():
    names = ["Lê Thái Tổ", "Lê Thái", "Lê Lợi", "Đại Cồ Việt", "Đại Việt", "Đoàn 58"]
    found = lambda t: [m[0] for m in python_pattern(V.gazetteer(names)).finditer(t)]
    assert found("Lê Thái Tổ, Lê-thái tổ, Lê Thái, Lê Tháia, lê Lợi, Lê  Lợi, xLê Lợi") == ["Lê Thái Tổ", "Lê-thái tổ", "Lê Thái"]
    assert found("Đại-cồ Việt Đại việt Đại VIỆT Đoàn 58 Đoàn-58 Đoàn 581") == ["Đại-cồ Việt", "Đại việt", "Đoàn 58", "Đoàn-58"]


def python_entities(sentence):
    found = []
    for seq, (label, pattern) in enumerate(V.rules(), 1):
        for m in python_pattern(pattern).finditer(sentence):
            st, en = m.span("own") if "own" in m.re.groupindex else m.span()
            found.append((st, -en, V.PRIORITY[label], seq, label))
    out, end = [], 0
    for st, minus, _, _, label in sorted(found):
        if st >= end:
            end = -minus
            if own := sentence[st:end].strip(" ,.;:!?()[]\"'-"):
                out.append((own, label.removesuffix("_RULE").removesuffix("_GAZ")))
    return out


def test_entities_of_documents(spark):
    got = Q.QUERIES["entities"](spark, SF).collect()
    assert len(got) > 5000 and sum(len(r.entities) for r in got) > 20
    assert all([(e.text, e.label) for e in r.entities] == python_entities(r.sentence) for r in got)
    summary = {r.chap_code: (r.n_sentences, r.n_entities) for r in Q.QUERIES["work_summary"](spark, SF).collect()}
    for code, counts in summary.items():
        own = [r for r in got if r.chap_code == code]
        assert counts == (len(own), sum(len(r.entities) for r in own))


class Model:
    def sentences(self, text):
        return text.split("|")

    def tokens(self, text):
        if "boom" in text:
            raise ValueError
        return [(w, "B-PER" if w.istitle() else "O") for w in text.split()]


def test_models(spark):
    normal = spark.createDataFrame([("w", 1, ["aaaa|bbbb", " cccc "]), ("w", 2, ["boom Nam|1"])], "chap_code string, page_no long, blocks array<string>")
    sents = corpus.sentences(normal, cutter=models.sentence_cutter(Model))
    got = corpus.entities(sents, models.token_tagger(Model)).orderBy("seq").collect()
    assert [(r.sentence, r.entities) for r in got] == [("aaaa", []), ("bbbb", []), ("cccc", []), ("boom Nam", [])]
    named = corpus.entities(spark.createDataFrame([("gặp Nam ở đây",)], "sentence string"), models.token_tagger(Model)).first()
    assert [tuple(e) for e in named.entities] == [("Nam", "PER")]
    if not models.available():
        with pytest.raises(ImportError):
            models.Pretrained()


def test_correction_goes_on_where_it_broke_off(spark, tmp_path, monkeypatch):
    calls, journal = tmp_path / "calls", str(tmp_path / "journal")

    class Client:
        def generate(self, prompt, model):
            chunk = prompt[len(V.PROMPT) :]
            with calls.open("a") as f:
                f.write(chunk + "\n")
            if chunk.endswith("bad"):
                raise OSError
            return chunk.upper()

    missing = spark.createDataFrame([(f"k{i}", f"chunk {i}{' bad' * (i == 3)}") for i in range(20)], "key string, chunk string")
    real, left = correction.ask, [2]

    def breaking(*a):
        left[0] -= 1
        if left[0] < 0:
            raise RuntimeError("lost")
        return real(*a)

    monkeypatch.setattr(correction, "ask", breaking)
    with pytest.raises(RuntimeError):
        correction.ask_all(missing, Client, "m", journal, tasks=2, every=3)
    before = len(calls.read_text().splitlines())
    assert 0 < before < 20
    monkeypatch.setattr(correction, "ask", real)
    got = {r.key: (r.reply, r.failed) for r in correction.ask_all(missing, Client, "m", journal, tasks=2, every=3).collect()}
    assert got == {f"k{i}": (None, True) if i == 3 else (f"CHUNK {i}", False) for i in range(20)}
    asked = calls.read_text().splitlines()
    assert len(set(asked)) == 20 and all(asked.count(x) == 1 for x in asked if not x.endswith("bad"))


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    for code, name in (("A", "t_1.pdf"), ("A", "t_2.pdf"), ("B", "b.pdf")):
        (tmp_path / "in" / code).mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / code / name).write_text("Năm 1428, vua Lê Lợi lên ngôi. Câu thứ hai.|Trang sau.")

    class Reader:
        def toc(self, content):
            return 2, []

        def pages(self, content, start, end):
            yield from list(enumerate(content.decode().split("|"), 1))[start - 1 : end]

    class Client:
        def generate(self, prompt, model):
            return prompt[len(V.PROMPT) :].replace("hai", "HAI")

    monkeypatch.setenv("GEMINI_API_KEY", "x")
    out = tmp_path / "out"
    cli.main(["--input-dir", str(tmp_path / "in"), "--outdir", str(out), "--correct", "--no-models"], Reader, Client)
    assert (out / "A/A_01/A_01_seg.tsv").read_text().splitlines() == ["A_01_000001\tNăm 1428, vua Lê Lợi lên ngôi.", "A_01_000002\tCâu thứ HAI.", "A_01_000003\tTrang sau."]
    assert [e["label"] for e in json.loads((out / "B/B_ner.json").read_text())[0]["entities"]] == ["TME", "TITLE", "PER"]
    assert [json.loads(x)["action"] for x in (out / "corrections.jsonl").read_text().splitlines()].count("corrected") == 2
    assert "9 sentences" in capsys.readouterr().out and cache.load_table(spark, str(out / "cache/corrected")).count() == 2
    one = tmp_path / "one"
    cli.main(["--pdf", str(tmp_path / "in/B/b.pdf"), "--code", "C", "--outdir", str(one), "--limit", "1", "--no-models"], Reader)
    assert (one / "C/C_seg.tsv").read_text() == "C_000001\tNăm 1428, vua Lê Lợi lên ngôi.\n"
    for wrong in ("none", "in/A"):
        with pytest.raises(FileNotFoundError):
            pdf.folder_scan(spark, str(tmp_path / wrong))


def test_normalisation_runs_in_the_jvm_and_equals_unicodedata(spark):
    pages = spark.createDataFrame([("w", 1, "hoà bình")], "chap_code string, page_no long, raw string")
    assert "EvalPython" not in corpus.normalize(pages)._jdf.queryExecution().toString()
    given = [c + m for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x2000), 0x1100, 0xAC00, 0x212B, 0x1D15E]) for m in ("", "́", "̣̂", "ᆨ")] + ["", "plain", None]
    own = spark.createDataFrame([(t,) for t in given], "t string").select("t", text.nfc(F.col("t")).alias("x")).collect()
    assert all(r.x == (None if r.t is None else unicodedata.normalize("NFC", r.t)) for r in own) and len(own) == len(given)


def test_cache_join_asks_once(spark, tmp_path, monkeypatch):
    calls = tmp_path / "calls"

    class Client:
        def generate(self, prompt, model):
            assert prompt.startswith(V.PROMPT)
            with calls.open("a") as f:
                f.write(str(hash(prompt)) + "\n")
            return prompt[len(V.PROMPT) :]

    monkeypatch.setattr(Q, "DemoClient", Client)
    assert Q.QUERIES["cache_join"](spark, SF).groupBy("action").count().count() == 2
    asked = calls.read_text().splitlines()
    assert len(asked) == len(set(asked)) > 50


def test_cheap_tests_hide_nothing(spark):
    spaces = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and chr(c).isspace() and not 0x1C <= c <= 0x1F]
    assert sorted(spaces) == sorted(text.SPACES)
    names = [*V.TITLES, *V.PLACE_CUES.split("|"), *V.PERSON_CUES.split("|"), *V.BODIES, *V.PEOPLE, *V.PLACES, *"ngày tháng năm niên đời mùa thế giờ thời nhà triều".split()]
    cases = [(v,) for n in names for v in (n, n.upper(), n.title(), "x " + n.replace(" ", "-") + " y")]
    assert spark.createDataFrame(cases, "s string").filter(~F.col("s").rlike(V.cue())).collect() == []
    plain = spark.createDataFrame([("Das war nicht so schön, déjà vu.",), ("The whole job is done here.",)], "s string")
    assert plain.filter(F.col("s").rlike(V.cue())).count() == 0
    blanks = {"a  b\r\nc\x85d e": "a b c d e", "x ( y ) , z ;w": "x (y), z;w", "d-\nụ-\nA.B.Đ": "dụ-\nA. B. Đ".replace("-\n", "- "), "  a\t": "a"}
    own = spark.createDataFrame([(t,) for t in blanks], "t string").select("t", F.array_join(text.blocks(F.col("t")), "|").alias("x"), text.respace(F.array_join(text.lines(F.col("t")), "\n")).alias("y"))
    assert {r.t: r.y for r in own.collect()} == blanks


def test_limit_leaves_out_later_pages(spark):
    pages = spark.createDataFrame([("w", p, [f"{p}{i}" for i in range(p % 3)]) for p in [*range(40), 1, 1]], "w string, p long, items array<string>")
    placed = numbering.with_offsets(pages, "w", "p", "items", 4)
    assert sorted((r.p, r.offset) for r in placed.collect()) == [(1, 0), (1, 1), (1, 2), (2, 3)]
    got = numbering.explode_numbered(pages, "w", "p", "items", "item", 4).orderBy("seq").collect()
    assert [(r.seq, r.item) for r in got] == [(1, "10"), (2, "10"), (3, "10"), (4, "20")]
