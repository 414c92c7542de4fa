import hashlib
import random
import re

from rosterlake.llm import secrets
from rosterlake.llm.secret_automaton import alt, compile_rules, lit, one, opt, rep, seq
from tests.llm.corpus import SCHEMA, awkward, documents

KEYWORDS = "password passwd secret token api_?key".split()
EITHER = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in KEYWORDS)
ASSIGN = re.compile(rf"""({EITHER})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
BASE = {
    "assign": lambda t: [m.span() for m in ASSIGN.finditer(t) if len(m[2]) >= 6],
    "access": lambda t: [m.span() for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20],
    "hex": lambda t: [m.span() for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24],
}
FURTHER = {
    "github": "gh[pousr]_[A-Za-z0-9]+", "google": "AIza[A-Za-z0-9_-]+", "slack": "xox[abprs]-[A-Za-z0-9-]{10,}",
    "stripe": "[sr]k_live_[A-Za-z0-9]+", "private_key": "-----BEGIN (RSA |EC |OPENSSH )?PRIVATE KEY-----",
}
LEAST = {"github": 40, "google": 39, "slack": 15, "stripe": 32, "private_key": 0}
PARTS = [
    "token", "=", ":", " ", '"', "'", "secret", "0123abcdef", "AKIA", "ABCDEFGHIJKLMNOP", "é", "\n", "PassWord",
    "api_key", "APIKEY", "deadbeef" * 3, ".", "-", "x,", "ghp_", "Az09" * 10, "AIza", "xoxb-", "sk_live_",
    "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN ",
]


def brute(text):
    found = [(a, i, b) for i, find in enumerate(BASE.values()) for a, b in find(text)]
    for i, (kind, pattern) in enumerate(FURTHER.items(), 3):
        found += [(m.start(), i, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= LEAST[kind]]
    return sorted(found)


def test_against_expressions(spark):
    rnd = random.Random(3)
    rows = [(i, "".join(rnd.choices(PARTS, k=rnd.randint(0, 300))), "aa", "s") for i in range(300)]
    rows += [(1000 + i, t, None, None) for i, (_, t, *_) in enumerate(awkward())]
    rows.append((2000, "a1" * 60_000 + " token = 'x" + "y" * 5000, "aa", "s"))
    found = secrets.digest(secrets.find_secrets(documents(spark, rows))).collect()
    kinds = [r.kind for r in secrets.RULES]
    texts = {d: t or "" for d, t, *_ in rows}
    for r in found:
        want = brute(texts[r.doc_id])
        joined = [f"{kinds[k]}:{a}:{b}" for a, k, b in want]
        assert r.spans == ",".join(joined)
        base = ",".join(j for j, (_, k, _) in zip(joined, want) if k < 3)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == n for _, k, _ in want) for n in range(3)]


def test_columns_pass_through(spark):
    docs = documents(spark, awkward()).withColumnRenamed("score", "spans")
    found = secrets.find_secrets(docs)
    assert set(found.columns) == set(docs.columns) and found.where("size <> 'mine'").isEmpty()
    assert secrets.find_secrets(spark.createDataFrame([], SCHEMA)).collect() == []


def test_automaton_is_minimal_and_right():
    rules = [seq(lit("ab"), rep(one("0-9"), 2, 3)), alt(lit("a"), seq(opt(one("x")), lit("abc")))]
    patterns = [re.compile(rb"ab[0-9]{2,3}\Z"), re.compile(rb"(a|x?abc)\Z")]
    machine = compile_rules(rules, search=False)
    rnd = random.Random(1)
    for _ in range(3000):
        data = bytes(rnd.choices(b"abcx019", k=rnd.randint(0, 6)))
        state = machine.start
        for b in data:
            state = machine.table[state, machine.classes[b]]
        assert machine.accepts[state] == {i for i, p in enumerate(patterns) if p.match(data)}
    # No two states accept alike and move alike.
    rows = {(tuple(sorted(a)), *row) for a, row in zip(machine.accepts, machine.table.tolist())}
    assert len(rows) == machine.states
