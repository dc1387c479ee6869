import re

import pytest
from llm_odd import ODD, table  # noqa: F401
from pyspark.sql import functions as F

from tidewatch.llm import secrets
from tidewatch.sources.staging import staging_path

KEY = "AKIA" + "Q" * 16
TEXTS = [
    *ODD,
    'Password = "abcdef1" token=token:abcdefg API_KEY: zzzzzzz secret=x',
    f"{KEY} AKIAshort AKIA{'9' * 30}x",
    "deadbeef" * 4 + " é🙂 " + "0123456789abcdef" * 2,
    "ghp_" + "a" * 36 + " and -----BEGIN RSA PRIVATE KEY-----",
    "password=abcdef " * 500,
    "-----BEGIN " + "ABC " * 50_000 + "-----BEGIN PRIVATE KEY----- -----BEGIN OPENSSH 2 PRIVATE KEY BLOCK-----",
    "9" * 1_000_000,
]


def brute(text):
    out = []
    for rank, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text or "", re.ASCII):
            if len(m[rule.group]) >= rule.least:
                out.append((m.start(), rank, m.end(), rule.kind))
    return [(kind, start, end) for start, _, end, kind in sorted(out)]


def found(docs, ledger, rules=secrets.RULES):
    rows = secrets.findings_by_path(docs, ledger, ["doc_id"], rules).collect()
    return sorted((r["doc_id"], [tuple(f) for f in r["findings"]]) for r in rows)


def test_findings_against_brute_force(spark, table):
    ledger = secrets.Ledger(spark, staging_path(spark, "ledger"))
    secrets.update(table(TEXTS), ledger)
    assert found(table(TEXTS), ledger) == [(i, brute(t)) for i, t in enumerate(TEXTS)]


def test_fifty_thousand_matches(spark, table):
    texts = ["é password=abcdef " * 50_000, "password=abcdef " * 256, "password=abcdef " * 257]
    ledger = secrets.Ledger(spark, staging_path(spark, "ledger"))
    secrets.update(table(texts), ledger, secrets.BASE[:1])
    want = [[("assign", m.start(), m.end()) for m in re.finditer("password=abcdef", t)] for t in texts]
    assert found(table(texts), ledger, secrets.BASE[:1]) == list(enumerate(want))


@pytest.mark.parametrize("sent", [0, secrets.MAX_UNSEEN])
def test_ledger_scans_unseen_pairs_only(spark, table, monkeypatch, sent):
    monkeypatch.setattr(secrets, "MAX_UNSEEN", sent)
    ledger = secrets.Ledger(spark, staging_path(spark, "ledger"))
    two = secrets.BASE[:2]
    secrets.update(table([TEXTS[-5], TEXTS[-5], "plain"]), ledger, two)
    assert ledger.read().count() == 2  # copies are one blob
    secrets.update(table([TEXTS[-5], "plain", "new " + KEY]), ledger, two)
    assert ledger.read().count() == 3
    secrets.update(table([TEXTS[-5], "plain"]), ledger, secrets.BASE)
    added = ledger.read().where(F.size("versions") == 1).collect()
    assert len(added) == 2 and {v for r in added for v in r["versions"]} == {secrets.BASE[2].version}
    secrets.update(table([TEXTS[-5], "plain"]), ledger, secrets.BASE)
    assert ledger.read().count() == 5
    assert [len(f) for _, f in found(table(["plain", "new " + KEY]), ledger, two)] == [0, 1]


def test_changed_rule_has_its_own_version(spark, table):
    ledger = secrets.Ledger(spark, staging_path(spark, "ledger"))
    strict = secrets.Rule("hex", r"[0-9a-f]{60,}", least=60)
    secrets.update(table(["ab" * 20]), ledger, [secrets.BASE[2]])
    assert len(found(table(["ab" * 20]), ledger, [secrets.BASE[2]])[0][1]) == 1
    secrets.update(table(["ab" * 20]), ledger, [strict])
    assert ledger.read().count() == 2
    assert found(table(["ab" * 20]), ledger, [strict])[0][1] == []


def test_empty_table(spark, table):
    ledger = secrets.Ledger(spark, staging_path(spark, "ledger"))
    none = table(["a"]).where("false")
    secrets.update(none, ledger)
    assert found(none, ledger) == []
