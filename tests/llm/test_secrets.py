import hashlib
import random
import re
import string

from logquarry.llm import secrets as S
from tests.llm.cases import MEDIUM, ROWS, documents, frame

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(("assign", "access", "hex")[k], i, j) for i, k, j in sorted(found)]


def line(spans):
    return ",".join(f"{k}:{i}:{j}" for k, i, j in spans)


def test_query(spark):
    texts = {r.doc_id: r.text for r in documents(spark, MEDIUM).collect()}
    got = {r.doc_id: r for r in S.op7_randomness_battery(spark, MEDIUM).collect()}
    assert set(got) == set(texts)
    some = 0
    for key, text in texts.items():
        want, r = base(text), got[key]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == n for k, *_ in want) for n in ("assign", "access", "hex")]
        assert r.base_sha256 == hashlib.sha256(line(want).encode()).hexdigest()
        spans = [x for x in r.spans.split(",") if x and not x.startswith("random")]
        assert ",".join(spans) == line(want)
        some += bool(want)
    assert some > 10


def spans_of(spark, texts):
    rows = [(k, t, None, None, None) for k, t in enumerate(texts)]
    found = S.find_secrets(frame(spark, rows)).collect()
    return {r.doc_id: [(s.kind, s.begin, s.end) for s in r.spans] for r in found}


def test_shapes(spark):
    texts = [
        'token:secret: abcdefghijklmno', "token=password=abcdefghijkl", "TOKEN = 'abcdefghijkl'", 'Api_Key": "a.b-c_d/e+f=g"',
        "xtoken:abcdefghijk", "AKIA" + "A" * 13, "AKIA" + "A" * 14, "AKIAAKIA" + "A" * 12, "0123456789abcdeF0123456789abcdef",
        "é🎉 token=aaaaaaaaaaaa 🎉 " + "a" * 16, "secret" + " " * 50_000 + "x", "token " * 3_000, "a" * 100_000, None, "",
    ]
    got = spans_of(spark, texts)
    for k, text in enumerate(texts):
        assert [s for s in got[k] if s[0] != "random"] == base(text), text and text[:40]


def test_rows_of_all_kinds(spark):
    got = sorted((line([(s.kind, s.begin, s.end) for s in r.spans if s.kind != "random"]) for r in S.find_secrets(frame(spark)).collect()))
    assert got == sorted(line(base(r[1])) for r in ROWS)


def prose(rng, words):
    parts = ["er", "an", "th", "on", "in", "ing", "tion", "al", "re", "st", "ment", "ous", "le", "qu", "ver", "pro"]
    return " ".join("".join(rng.choices(parts, k=rng.choice([1, 2, 2, 3, 3, 4, 6, 9]))) for _ in range(words))


def test_random_strings_are_found_and_words_left_alone(spark):
    rng = random.Random(11)
    alphabets = [string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits, string.digits + "abcdef", string.ascii_uppercase + "234567"]
    planted, texts = {}, []
    for k in range(400):
        text = prose(rng, 150)
        if k % 4 == 0:
            secret = "".join(rng.choices(alphabets[k // 4 % 4], k=rng.choice([24, 32, 40, 64])))
            planted[k] = (len(text) + 1, len(text) + 1 + len(secret))
            text += " " + secret + " " + prose(rng, 50)
        if k % 7 == 0:
            text += " " + "incomprehensibilities/counterrevolutionaries" + " A" + "a" * 30 + " ----------------------- " + "1" * 25
        texts.append(text)
    got = spans_of(spark, texts)
    found = {k: [s[1:] for s in spans if s[0] == "random"] for k, spans in got.items()}
    caught = sum(planted[k] in found[k] for k in planted)
    wrong = sum(len([s for s in spans if s != planted.get(k)]) for k, spans in found.items())
    assert caught >= 0.9 * len(planted), caught
    assert wrong <= 1, wrong


def test_main_path_is_native(spark):
    text = S.op7_randomness_battery(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", text)
