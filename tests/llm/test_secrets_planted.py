"""Keys of formats that the automata never saw, planted inside the table's own documents: how many are found, and what else is."""

import random
import string

import duckdb

from presslens.llm import secrets

DIR = "/root/testdata/sf0.001"
ALNUM, UPPER, URL = string.ascii_letters + string.digits, string.ascii_uppercase + string.digits, string.ascii_letters + string.digits + "_-"
#: Formats of other makers than those of the training sample.
FORMATS = {
    "dop": lambda r: "dop_v1_" + "".join(r.choices("0123456789abcdef", k=64)),
    "figd": lambda r: "figd_" + "".join(r.choices(URL, k=40)),
    "shpat": lambda r: "shpat_" + "".join(r.choices("0123456789abcdef", k=32)),
    "jwt": lambda r: ".".join("eyJ" + "".join(r.choices(URL, k=n)) for n in (33, 60)) + "." + "".join(r.choices(URL, k=43)),
    "square": lambda r: "EAAA" + "".join(r.choices(URL, k=60)),
    "plain": lambda r: "".join(r.choices(ALNUM, k=40)),
    "license": lambda r: "-".join("".join(r.choices(UPPER, k=5)) for _ in range(5)),
}


def test_planted_keys(spark):
    r = random.Random(11)
    texts = [t for (t,) in duckdb.connect().execute(f"SELECT text FROM '{DIR}/documents.parquet' WHERE text <> '' ORDER BY doc_id").fetchall()]
    rows, planted = [], {}
    for i, text in enumerate(texts):
        name = list(FORMATS)[i % len(FORMATS)]
        words = text.split(" ")
        at = r.randrange(len(words) + 1)
        before = " ".join(words[:at]) + (" " if at else "")
        key = FORMATS[name](r)
        planted[i] = (name, len(before), len(before) + len(key))
        rows.append((i, before + key + (" " if at < len(words) else "") + " ".join(words[at:])))
    got = {x.doc_id: list(zip(x.kinds, x.starts, x.ends, strict=True)) for x in secrets.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    plain = {x.doc_id: x.kinds.count("auto") for x in secrets.scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    found = {n: [] for n in FORMATS}
    for i, (name, start, end) in planted.items():
        covered = set().union(*[range(max(a, start), min(b, end)) for _, a, b in got[i]])  # a key with dots is several spans
        found[name].append(len(covered) >= 0.6 * (end - start))
    recall = sum(map(sum, found.values())) / len(planted)
    megabytes = sum(len(t.encode()) for t in texts) / 1e6
    false = sum(plain.values()) / megabytes
    print(f"recall {recall:.3f}, by format { {n: round(sum(f) / len(f), 2) for n, f in found.items()} }, other spans per MB {false:.2f}")
    assert recall >= 0.9 and false <= 2
