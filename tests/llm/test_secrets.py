"""Secret scan against texts built from known literals and against plain patterns."""

import hashlib
import random
import re
import time

import pytest

from souklake.llm import secrets
from souklake.llm.queries import QUERIES

KEY = "aB3$xY9z_Q1w"
OTHER = "kL7!mN2v-R5t"


def found(text):
    return [(s.kind, text[s.start : s.end]) for s in secrets.scan_text(text)]


@pytest.mark.parametrize(
    "text",
    [
        f'pw_secret_of = "{KEY}"',
        f"private_pwd = '{KEY}'",
        f"dbPwd = `{KEY}`",
        f'dbPwd = """{KEY}"""',
        f'dbPwd := r"{KEY}"',
        f'dbPwd = f"{{x}}{KEY}"',
        f'export DB_PWD="${{BASE}}{KEY}"',
        f"db_pwd: |\n  {KEY}\nother: 1",
        f'{{"db_pwd": ["{KEY}"]}}',
        f'{{"db_pwd": "{KEY}", "x": 1}}',
        f'x = "{{\\"db_pwd\\": \\"{KEY}\\"}}"',
        f'<add key="dbPwd" value="{KEY}"/>',
        f'<entry key="dbPwd">{KEY}</entry>',
        f"<dbPwd>\n {KEY}\n</dbPwd>",
        f'- name: DB_PWD\n  value: "{KEY}"',
        f'conn = "Server=x;Pwd={KEY};"',
        f'db_pwd: str = "{KEY}"',
        f"config['db_pwd'] = '{KEY}'",
        f"don't tell: pwd = '{KEY}'",
        f"auth_tokens_of:\n  - {KEY}\n  - word\n",
        f'base = "{KEY}"\nmiddle = base\ndb_pwd = middle',
        f'db_pwd = prefix + "{KEY}" + suffix',
        f"run --db-pwd={KEY} x",
        f"db_pwd = {KEY}\r\n",
    ],
)
def test_syntax_of_one_literal(text):
    assert found(text) == [("literal", KEY)]


def test_folded_constants():
    assert found(f'base = "{KEY}"\ndb_pwd = base + "{OTHER}"') == [("literal", KEY), ("literal", OTHER)]
    assert found('a = "aB3$"\na += "xY9z_Q1w"\ndb_pwd = a') == [("literal", "aB3$"), ("literal", "xY9z_Q1w")]
    assert found('db_pwd = ("aB3$xY"\n   "9z_Q1w")') == [("literal", "aB3$xY"), ("literal", "9z_Q1w")]
    assert found(f'base = "{KEY}"\ndb_pwd = f"{{base}}{OTHER}"') == [("literal", KEY), ("literal", OTHER)]
    assert found('pw = "x"\ndb_pwd = "ab\\"cdEF12$xyz9"') == [("literal", 'ab\\"cdEF12$xyz9')]
    # Ever longer constants: each literal is reported once.
    assert found('a = "aB3$xY9z"\n' + "a = a + a\n" * 200 + "db_pwd = a") == [("literal", "aB3$xY9z")]


@pytest.mark.parametrize(
    "text",
    [
        "pwd = getpass.getpass()", "pwd = tokens[3]", f'title = "{KEY}"', 'pwd = "${PWD}"', "pwd: |\n", "pwd =", "pwd:", 'pwd = "', "pwd == 'aB3$xY9z_Q1w'",
        "std::pwd::aB3", "db_pwds:\n- banana\n- cherry", "",
    ],
)
def test_no_literal(text):
    assert found(text) == []


def test_random_programs():
    draw = random.Random(3)
    for _ in range(300):
        lines, want, known = [], [], []
        for i in range(draw.randrange(1, 12)):
            literal = "".join(draw.sample("abcdefgh", 4) + draw.sample("ABCDEFGH", 4) + draw.sample("23456789", 4) + ["$"])
            secret = draw.random() < 0.5
            name = f"{draw.choice(['db_pwd', 'authToken_of', 'client-passphrase']) if secret else draw.choice(['title', 'place', 'color'])}_{'xyz'[i % 3]}{i}"
            form = draw.choice(['{n} = "{v}"', "{n}: '{v}'", '"{n}": "{v}",', "{n} := `{v}`", '<add key="{n}" value="{v}"/>', "<{n}>{v}</{n}>", "{n}={v}", "{n}: >\n   {v}\nplace: x"])
            lines.append(form.format(n=name, v=literal))
            if secret:
                want.append(literal)
            elif form[:5] == "{n} =" or form[:4] == "{n}:" and ">" not in form:
                known.append((name, literal))
            if known and draw.random() < 0.3:
                source, carried = draw.choice(known)
                lines.append(f"db_pwd_{i} = {source}")
                want.append(carried)
        text = "\n".join(lines)
        assert sorted(value for _, value in found(text)) == sorted(set(want)), text


def plain_base(text):
    kinds = {
        "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?(?P<v>[A-Za-z0-9+/_.=-]+)""", 6),
        "access": (r"(?P<v>AKIA[A-Z0-9]+)", 20),
        "hex": (r"(?P<v>[0-9a-f]+)", 24),
    }
    spans = [(m.start(), at, kind, m.end()) for at, (kind, (rule, least)) in enumerate(kinds.items()) for m in re.finditer(rule, text, re.ASCII) if len(m["v"]) >= least]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(spans)]


def test_query_against_plain_patterns(spark, tmp_path):
    draw = random.Random(8)
    parts = ["password", "PASSWD", "Secret", "token", "api_key", "ApiKey", '"', "'", " ", " ", ":", "=", "AKIA", "ABCDEFGH0123", "0123456789ab", "cdef01234567", "é🙂", "x.y", "\n", "ſ", "K"]
    rows = [(i, "".join(draw.choices(parts, k=draw.randrange(60)))) for i in range(400)] + [(900, None), (901, ""), (7, "again: token=abcdefgh"), (None, "AKIA" + "B" * 16)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op5_secret_scan"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    want = []
    for doc_id, text in rows:
        base = plain_base(text or "")
        counts = [sum(x.startswith(kind) for x in base) for kind in ("assign", "access", "hex")]
        want.append((doc_id, *counts, hashlib.sha256(",".join(base).encode()).hexdigest()))
    key = lambda row: tuple(map(str, row))
    assert sorted((tuple(r)[:5] for r in got.collect()), key=key) == sorted(want, key=key)
    assert sum(row[1] + row[2] + row[3] for row in want) > 300
    assert {len(r.spans.split(",")) - (not r.spans) >= r.n_assign + r.n_access + r.n_hex for r in got.collect()} == {True}


@pytest.mark.parametrize("text", ['a="', 'a="\\"', "a=[", 'a=["', "a=b+", "a=a+a\n", 'a=a+"x"\n', 'a="""', "<a>", '<a b="x">', "a:\n- ", "x: |\n", "a:a:", "pwd='\\", 'pwd=f"{', "a: b = "])
def test_time_is_linear(text):
    started = time.process_time()
    secrets.scan_text(text * 60_000)
    assert time.process_time() - started < 10
