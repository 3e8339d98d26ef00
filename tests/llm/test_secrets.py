"""Secret scans: the base patterns against a plain scan, and what the lexer adds."""

from __future__ import annotations

import hashlib
import re
import time

import pytest
from hypothesis import given, settings, strategies as st

from reelhouse.llm import secrets as s
from reelhouse.llm.queries import op5_secret_scan

SCAN = s.Scan()
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain(text):
    """Scan by scan, dropping what is too short afterwards."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found, key=lambda x: (x[1], s.KINDS.index(x[0])))


PARTS = ["password", "Token", "SECRET", "apiKey", "api_key", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGH12", "0123456789abcdef", "deadbeef", "é", "😀", "\n", "ſecret", "abc/def+ghi=.-", "Z"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
def test_base_spans(text):
    assert sorted(s.base_spans(text), key=lambda x: (x[1], s.KINDS.index(x[0]))) == plain(text)
    assert [x for x in s.spans_of(text, SCAN) if x[0] != "literal"] == plain(text)


def literals(text):
    return [text[a:b] for _, a, b in s.literal_spans(text, SCAN)]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('db_password = "Tr0ub4dor&3x"', ["Tr0ub4dor&3x"]),
        ("credentials: xK9#mP2$vL5q", ["xK9#mP2$vL5q"]),
        ('KEY_PART = "zQ8rT5wX1p"\nclient_secret = KEY_PART', ["zQ8rT5wX1p"]),
        ('auth_token := "aB3dE5" + "fG7hI9jK"', ["aB3dE5", "fG7hI9jK"]),
        ('{"accessToken": "qW3eR5tY7u", "name": "qW3eR5tY7u"}', ["qW3eR5tY7u"]),
        ('password = "changeme_example"', []),
        ("password = ${VAULT_PASSWORD}", []),
        ('title = "Tr0ub4dor&3x"', []),
        ("the password: see below", []),
        ("a = b\nb = a", []),
    ],
)
def test_literals_by_target_name(text, expected):
    assert literals(text) == expected


V, W = "zQ8rT5wX1p", "aB3dE5fG7h"


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (f'A = "{V}"\nB = "{W}"\nclient_secret = A + B', [V, W]),
        (f'password = "abc9X" + B\nB = "{V}"', ["abc9X", V]),
        (f'cfg.key = "{V}"; client_secret = cfg.key', [V]),
        (f'cfg["key"] = "{V}"\nclient_secret = cfg["key"]', [V]),
        (f'client_secret = LATER\nx = 1\nLATER = "{V}"\nLATER = "{W}"', [V]),
        (f'os.environ["client_secret"] = "{V}"', [V]),
        (f'client_secret: str = "{V}"', [V]),
        (f'client_secret: Optional[dict[str, int]] = "{V}"', [V]),
        (f"app:\n  client_secret: |\n    {V}\n\n    {W}\n  other: 1", [V, W]),
        (f"password: >-\n  {V}\n{W}: 1", [V]),
        (f'{{"client_secret":\n    "{V}",\n "a": 1}}', [V]),
        (f'{{\\"client_secret\\": \\"{V}\\"}}', [V]),
        (f'client_secret:\n  nested: "{V}"', []),
        (f'password = (\n  "{V}"\n  "{W}"\n)', [V, W]),
        (f'client_secret = A + \\\n   B\nA = "{V}"\nB = "{W}"', [V, W]),
        (f'a = password = "{V}"', [V]),
        (f"it's = 1, client_secret = '{V}'", [V]),
        (f'token = b"{V}"', [V]),
        ('client_secret = ' + 3 * '"' + V + 3 * '"', [V]),
        (f'password = os.getenv("{V}")', []),
        (f'A = B\nB = A\npassword = A + "{V}"', [V]),
        (f'host: x, password = "{V}"', [V]),
    ],
)
def test_values_in_joins_subscripts_annotations_and_over_lines(text, expected):
    assert literals(text) == expected


@pytest.mark.parametrize(
    "text",
    [
        "x = " + '\\"' * 2_500_000,
        'x = "' + '\\"' * 2_500_000,
        "x = " + ('"' + "'") * 500_000,
        "token = " + "(" * 300_000,
        "token =\n" * 300_000,
        'token = "a" + ' * 100_000,
        "password: |\n  x\n" * 50_000,
        "a: b " * 100_000,
        "a: " + "b | " * 200_000,
        "a" + '["b"]' * 100_000 + " = 1",
        'a = ' + 3 * '"' + "x'" * 500_000 + ("\n= " + 3 * "'") * 1000,
        "password = " + "x" * 5_000_000,
        "".join(f"token{i} = token{i - 1}\n" for i in range(3_000)),
    ],
    ids=lambda t: t[:12],
)
def test_time_grows_with_the_length(text):
    """Well under a microsecond a character for the first two, a few at most for others; quadratic ones would take hours."""
    started = time.process_time()
    s.spans_of(text, SCAN)
    assert time.process_time() - started < (1 if '\\"' in text else 8)


def test_constants_follow_the_last_value_before_use():
    assert literals('A = "firstVALUE99"\nA = "secondVALUE77"\napi_token = A') == ["secondVALUE77"]


def test_masking_leaves_no_span_and_the_rest_as_it_is(spark):
    text = 'x password="abcdEFGH12345678" y 0123456789abcdef0 z'
    docs = spark.createDataFrame([(1, text, 50), (2, None, None), (3, "clean", 5)], "doc_id long, text string, n_chars long")
    out = {r.doc_id: r for r in s.mask_secrets(docs).collect()}
    assert out[1].text == 'x [SECRET]" y [SECRET] z' and out[1].n_chars == len(out[1].text)
    assert out[2].text is None and out[3].text == "clean"


def test_query(spark, folder, small):
    rows = {r.doc_id: r for r in op5_secret_scan(spark, folder).collect()}
    docs = small["documents"].collect()
    assert len(rows) == len(docs)
    for d in docs:
        base = plain(d.text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        r = rows[d.doc_id]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x[0] == k for x in base) for k in s.KINDS[:3])
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("literal")] == [x for x in joined.split(",") if x]


def test_edge_rows(edge_docs, no_docs):
    rows = s.scanned(edge_docs).collect()
    assert len(rows) == 14 and all(r.spans is not None for r in rows)
    assert s.mask_secrets(edge_docs).columns == edge_docs.columns and s.mask_secrets(edge_docs).count() == 14
    assert s.scanned(no_docs).count() == 0


@pytest.mark.parametrize("join", ["", '"" + '])
def test_constants_are_followed_however_many_there_are(join):
    chain = "".join(f"token{i} = {join}token{i - 1}\n" for i in range(1, 1_500))
    text = chain + 'other = token1499\ntoken0 = "abcdEFGH12345678"\n'
    assert literals(text)[-1:] == ["abcdEFGH12345678"]
    last = "x = 'abcdEFGH12345678'\n" + "".join(f"x{i} = {join}x{i - 1 if i > 1 else ''}\n" for i in range(1, 1_500)) + "secret = x1499"
    assert literals(last) == ["abcdEFGH12345678"]
    parts = "".join(f"x{i} = 'a'\n" for i in range(1_500)) + "y = 'EFGH12345678'\nsecret = " + " + ".join([*(f"x{i}" for i in range(1_500)), "y"])
    assert literals(parts) == (["a"] * 1_500 + ["EFGH12345678"] if s.literal_score("a" * 1_500 + "EFGH12345678") >= 1 else [])
    assert literals("a_token = b_token\nb_token = a_token") == []
