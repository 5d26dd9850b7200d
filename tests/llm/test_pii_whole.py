"""Personal data in every form that the operator names."""

import re

from presslens.llm import pii


def made(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(pii.pseudonymise(frame, "k").collect(), key=lambda r: r.doc_id)
    return [r.text for r in rows], rows


def test_phones_of_any_area_code_and_without_separators(spark):
    texts = ["call +1 (017) 555-7713 now", "call 1-132-555-1352 now", "call 0175557713 now", "call +12125550187 now", "call 212-555-0187 now", "call (212)5550187 now", "ratio 3.1415926535 and 12345678901234567890 a4087344558c"]
    got, rows = made(spark, texts)
    shape = lambda t: re.sub("[0-9]", "0", t)
    assert [r.n_phone for r in rows] == [1] * 6 + [0]
    assert got[6] == texts[6] and [shape(t) for t in got] == [shape(t) for t in texts]
    ten = [re.sub("[^0-9]", "", t)[-10:] for t in got[:6]]
    assert ten[0] == ten[2] != "0175557713" and ten[3] == ten[4] == ten[5] != "2125550187"
    assert [t[0] in "01" for t in ten] == [True, True, True, False, False, False]


def test_cards_beside_other_numbers(spark):
    cards = ["4111 1111 1111 1111 12/27", "4111 1111 1111 1111 123", "7 4111111111111111", "no.4111111111111111", "card-4111-1111-1111-1111", "555-0187 4111 1111 1111 1111", "4111111111111111 4111111111111111 99", "9807915762804495 77", "12-4111 11111111 1111 3", "123 9807 915762804495"]
    got, rows = made(spark, [f"x {c} y" for c in cards] + ["x (212) 555-0187 4111 1111 1111 1111 y", "ratio 1.4111111111111111", "4111111111111111@example.org", "1 " * 5000])
    assert [r.n_card for r in rows] == [1] * 6 + [2] + [1] * 4 + [0, 0] + [rows[-1].n_card]
    runs = [re.sub("[^0-9]", "", t) for t in got]
    own = runs[0][:16]
    assert own != "4111111111111111" and all(own in r for r in runs[:7]) and own in runs[8] and own in runs[10]
    assert runs[7][:16] == runs[9][3:] != "9807915762804495"
    assert got[0].endswith(" 12/27 y") and got[1].endswith(" 123 y") and got[2].startswith("x 7 ") and rows[10].n_phone == 1
    assert got[11] == "ratio 1.4111111111111111" and rows[12].n_email == 1 and len(got[13]) == 10000
