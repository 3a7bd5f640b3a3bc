import hashlib
import random
import re
import time

import duckdb
import pytest

from tests.conftest import SF
from tests.llm.conftest import NASTY
from tierforge.llm import personal
from tierforge.llm.oracles import ORACLES
from tierforge.llm.queries import QUERIES


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


def number(s):
    return int(s.lstrip("0")[:4] or 0)


def expected(text):
    """Each kind by one pattern over the whole text, anchors apart."""
    front = r"(?:^|(?<![A-Za-z0-9]))(?:%s)"
    cues = "|".join(s for c in personal.CUES for s in personal.spellings(c))
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 0, lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", 0, lambda s: all(number(n) <= 255 for n in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", 0, lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0, lambda s: 8 <= len(digits(s)) <= 15),
        ("link", "[A-Za-z]+" + personal.LINK, 0, lambda s: s.split(":")[0].lower() in personal.SCHEMES),
        ("iban", front % "|".join(personal.spellings("iban")) + personal.JOINT + f"({personal.IBAN})", 1,
         lambda s: int("".join(str(int(c, 36)) for c in s.replace(" ", "")[4:] + s[:4])) % 97 == 1),
        ("account", front % cues + personal.JOINT + f"({personal.ACCOUNT})", 1,
         lambda s: 6 <= len(digits(s)) <= 34),
    ]
    out = []
    for kind, pattern, group, holds in rules:
        for m in re.finditer(pattern, text):
            s = m[group]
            s = s.rstrip(personal.OPEN_END) if kind == "link" else s
            if holds(s):
                out.append((kind, m.start(group), m.start(group) + len(s)))
    return out


TEXTS = [
    *(t for _, t, _ in NASTY),
    "a@b.c@d.e a@b@c.d @x.y x@y x@y. x@y.z. .@-.- a%+b@c-d.e.f,g@h.i",
    "1.2.3.4.5.6.7.8.9 1..2.3.4.5 256.1.1.1 0255.001.0.9 1.2.3 1.2.3. 999.1.2.3.4 00000000256.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1111; 4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111 4111111111111112 41111111111111114111111111111111",
    "+1 (243) 555-5526. +12 +1 +1-2 ++12345678 +1(2)3(4)5.6-7 8) +1 234 567 890 123 456 7 +1234567+12345678",
    "see https://bob:pw@host.example.org:80/a?b=c. (http://a.b) xhttp://a.b HTTP://A.B/c://d://e FTP://x",
    "http://a.b/http://c.d/ ://a.b a://b ssh://u@h.i,http://",
    "IBAN: GB82 WEST 1234 5698 7654 32, iban DE89370400440532013000 iban=DE88370400440532013000 xiban DE89370400440532013000",
    "Account no. 1234-5678 account 12345 ACCT#AB-123456 passport number: C01X00T47 ssn 078-05-1120 ssn078051120",
    "tax id 12 34 56 78 customer id = AB 1234567 konto: 1234567890 ssn ssn 123456 ssn:123456ssn:123456",
    "٣٤٥٦ ４１１１ é@è.fr \U0001f389 bob@mail7.example.com \U0001f389 97.51.17.173",
]


def test_spans_equal_patterns(docs_of):
    rows = [(k, t, "s") for k, t in enumerate(TEXTS)]
    got = personal.personal_spans(docs_of(rows)).collect()
    assert len(got) == len(rows)
    kinds = set()
    for row in got:
        spans = [tuple(s) for s in row["spans"]]
        assert spans == expected(TEXTS[row["doc_id"]] or ""), TEXTS[row["doc_id"]]
        kinds |= {s[0] for s in spans}
    assert kinds == set(personal.KINDS)


def test_random_texts_equal_patterns():
    draw, automaton = random.Random(5), personal._automaton()
    parts = [*"0123456789", *"@@.+-() :/=aZx%", "://", "http", "ssn", "iban", "IBAN", "255", "4111111111111111", "é", "no"]
    for _ in range(4000):
        text = "".join(draw.choices(parts, k=draw.randint(0, 60)))
        found = personal.text_spans(text, automaton)
        assert [(k, *s) for k, spans in found.items() for s in spans] == expected(text), text


@pytest.mark.parametrize("piece", ["1", "1.", "a@", "a@b.", "://", "http://a.b/", "+1", "ssn ", "SSN 1", "a", "IBAN AA11"])
def test_long_runs_take_time_in_proportion(piece):
    automaton, text = personal._automaton(), piece * (1_000_000 // len(piece))
    start = time.perf_counter()
    personal.text_spans(text, automaton)
    assert time.perf_counter() - start < 20


def test_no_documents(docs_of):
    assert personal.personal_spans(docs_of([])).count() == 0


def test_query(spark):
    text = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op12_anchored_personal_data"](spark, SF).collect()
    assert len(rows) == len(text) and sum(r["n_card"] for r in rows) > 0
    for r in rows:
        spans = expected(text[r["doc_id"]] or "")
        base = [s for s in spans if s[0] in personal.BASE_KINDS]
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert r["spans"] == ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        for kind in personal.KINDS:
            assert r[f"n_{kind}"] == sum(s[0] == kind for s in spans)


def test_sql_says_the_same_of_every_kind(spark, tmp_path):
    """The given documents hold base kinds only; here the SQL meets the others too."""
    rows = [(k, t) for k, t in enumerate(TEXTS) if t is None or len(t) < 1000]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    wanted = duck.sql(ORACLES["op12_anchored_personal_data"])
    got = QUERIES["op12_anchored_personal_data"](spark, str(tmp_path)).select(*wanted.columns).collect()
    assert sorted(tuple(r) for r in got) == sorted(wanted.fetchall())
