"""Secret scans: base findings against brute force, and layers that hide some."""

from __future__ import annotations

import base64
import gzip
import random
import textwrap
import time
import zlib
from urllib.parse import quote

import pyarrow as pa
import pytest

from eventmart.llm import secrets
from eventmart.llm.queries import queries
from tests.llm import brute

SECRET = 'token = "abcdef123456"'


def b64(raw: bytes) -> str:
    return base64.b64encode(raw).decode()


LAYERS = {
    "percent": quote(SECRET, safe=""),
    "percent twice": quote(quote(SECRET, safe=""), safe=""),
    "backslash u": "".join(f"\\u{ord(c):04x}" for c in SECRET),
    "backslash x": "".join(f"\\x{ord(c):02x}" for c in SECRET),
    "base64": b64(SECRET.encode()),
    "base64 of percent": b64(quote(SECRET, safe="").encode()),
    "base64 of base64": b64(b64(SECRET.encode()).encode()),
    "zlib": b64(zlib.compress(SECRET.encode() * 9)),
    "gzip": b64(gzip.compress(SECRET.encode())),
    "url safe, not padded": base64.urlsafe_b64encode(b"password=>>>???aaa~~~").decode().rstrip("="),
    "base64 with a no-break space": b64(f"\u00a0{SECRET}".encode()),
    "base64 of Latin-1": b64(f"caf\u00e9 {SECRET}".encode("latin-1")),
    "base64 of UTF-16": b64(SECRET.encode("utf-16-le")),
    "base64 of big-endian UTF-16": b64(SECRET.encode("utf-16-be")),
    "base64 in a path": f"https://h.example/q/{b64(SECRET.encode())}",
    "base64 of UTF-16 in a path": f"https://h.example/quote/{b64(SECRET.encode('utf-16-le'))}",
    "gzip in a path": f"https://h.example/q/{b64(gzip.compress(SECRET.encode())).rstrip('=')}",
    "base64 in lines": "\n".join(textwrap.wrap(b64(f"{'a line of text. ' * 9}{SECRET}".encode()), 64)),
    "base64 in lines cut within the secret": "\r\n".join(textwrap.wrap(b64(b"0123456789" * 4 + SECRET.encode()), 64)),
    "gzip in lines": "\n".join(textwrap.wrap(b64(gzip.compress(SECRET.encode())), 20)),
    "percent with zero": "".join(f"%{b:02x}" for b in f"\0{SECRET}".encode()),
    "percent of Latin-1": "".join(f"%{b:02x}" for b in f"\u00e9{SECRET}".encode("latin-1")),
    "percent of base64": quote(b64(SECRET.encode()), safe="") + "%3D",
}


@pytest.mark.parametrize("name", LAYERS)
def test_a_layer_is_unwrapped_and_its_span_is_the_run(name):
    text = f"Ünï before {LAYERS[name]} after"
    if name.startswith("url safe"):
        text = text.replace(LAYERS[name], base64.urlsafe_b64encode(b"password=aaa/bbb+ccc..").decode().rstrip("="))
    spans, layers, packed = secrets.scan(text)
    own = [s for s in spans if s[3] > 0 and s[0] == "assign"]
    assert own and layers > 1 and packed == 0
    for _, a, b, _ in own:
        assert text.startswith("Ünï before ") and 11 <= a < b <= len(text) - len(" after")
    assert secrets.suspects(pa.array([text, "nothing", None])).tolist() == [True, False, False]


def test_cycles_end_and_prose_has_one_layer():
    spans, layers, _ = secrets.scan("%2525%2525%25 \\u005cu005c")
    assert not spans and layers < 12
    assert secrets.scan("thationtionedshtherewith and nothing else")[1] == 1


def test_random_runs_have_no_layers():
    dice = random.Random(3)
    runs = [b64(dice.randbytes(dice.randint(12, 90))) for _ in range(2000)]
    assert sum(secrets.scan(run)[1] > 1 for run in runs) <= 4
    words = ["/".join("".join(dice.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(6)) for _ in range(2000)]
    assert sum(secrets.scan(w)[1] > 1 for w in words) <= 4


@pytest.mark.parametrize("unit", ["YWFh/", "eJ-", "H4sI/", "abcdefghijklmnopqrst\n", "/", "abcdefghijklmnop_%41"])
def test_very_long_runs_take_time_in_proportion(unit):
    began = time.time()
    secrets.scan(unit * 40_000 + SECRET)
    assert time.time() - began < 10


def test_base_spans_stay_when_layers_add_some():
    text = f"password: hunter2hunter2 AKIA{'Z9' * 8} {'0af' * 9} {LAYERS['base64']}"
    spans, _, _ = secrets.scan(text)
    counts, joined = brute.secrets(text)
    base = ",".join(f"{k}:{a}:{b}" for k, a, b, layer in spans if layer == 0)
    assert base == joined and sum(counts.values()) == 3 and len(spans) > 3


CASES = [
    (1, None), (2, ""), (3, SECRET), (4, "password: token: abcdefgh"), (5, "PASSWORD=abc"), (6, "api_key  =  'abcdefg"),
    (7, "AKIA" + "A" * 15), (8, "AKIA" + "A" * 16 + " " + "f" * 23 + " " + "f" * 24 + "F"), (9, "paſsword=abcdefg"),
    (10, "é" * 40 + " secret=" + "x" * 100_000), (11, "apiKey:abcdefgh token=a.b/c+d"), (3, SECRET), (None, SECRET),
]


def test_edge_cases(documents):
    found = secrets.find_secrets(documents(CASES).selectExpr("*", "1 as N_LAYERS"))
    rows = [(r["text"], ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in r["secret_spans"])) for r in found.collect()]
    assert sorted(rows, key=str) == sorted(((t, brute.secrets(t)[1]) for _, t in CASES), key=str)
    assert secrets.find_secrets(documents([])).count() == 0


def test_query_on_the_table(spark, sf_dir, small):
    texts = dict(small)
    for r in queries()["op3_secret_scan"](spark, sf_dir).collect():
        counts, joined = brute.secrets(texts[r["doc_id"]])
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(counts.values())
        assert r["base_sha256"] == brute.sha(joined)


def test_redaction(documents):
    kept = {r["doc_id"]: r["text"] for r in secrets.redact_secrets(documents([(1, f"a {SECRET} b"), (2, "clean"), (3, None)])).collect()}
    assert kept == {1: 'a [secret]" b', 2: "clean", 3: None}
    hidden = f"a {LAYERS['gzip']} b"
    assert secrets.redact_secrets(documents([(1, hidden)])).first()["text"] == "a [secret] b"
