"""Composite review and parallel-text pipelines."""

import os

from quarry.operators import reviews
from quarry.sources.files import read_csv_quoted


def test_prepare_reviews(spark, tmp_dir):
    p = os.path.join(tmp_dir, "reviews.csv")
    with open(p, "w") as f:
        f.write('id,name,weight,dateAdded,dateUpdated,reviews.date,reviews.rating,'
                'reviews.numHelpful,reviews.text,reviews.title,reviews.username,other\n')
        f.write('A1,"Kindle, 6""",16 ounces,2015-10-30T08:59:32Z,2016-01-01T00:00:00Z,'
                '2016-02-01T10:00:00Z,5,3,"Great, ""really""\ngood",Nice,bob,x\n')
        f.write('A2,Echo,1000 grams,bad date,,2017-01-01T00:00:00Z,x,,short,,ann,y\n')
    raw = read_csv_quoted(spark, p)
    out = reviews.prepare_reviews(raw)
    rows = {r.id: r for r in out.collect()}
    assert "other" not in out.columns and "customerReviews" in out.columns
    a1, a2 = rows["A1"], rows["A2"]
    assert a1.name == 'Kindle, 6"' and a1.customerReviews == 'Great, "really"\ngood'
    assert a1.weight_value == 1.0 and a1.units == "lbs" and abs(a2.weight_value - 2.20462) < 1e-12
    assert str(a1.dateAdded) == "2015-10-30 08:59:32" and a2.dateAdded is None
    assert a1.rating == 5.0 and a2.rating is None and a1.helpfullness == 3
    assert str(a1.reviewsDate) == "2016-02-01 10:00:00"


def test_prepare_parallel_text(spark, tmp_dir):
    en = os.path.join(tmp_dir, "en.txt")
    vi = os.path.join(tmp_dir, "vi.txt")
    with open(en, "w", encoding="utf-8") as f:
        f.write("Hello, World!\nIt's 3pm now.\nHello, World!\n")
    with open(vi, "w", encoding="utf-8") as f:
        f.write("Xin chào!\nBây giờ là 3 giờ.\nChào thế giới\nextra line\n")
    out = {r.line_no: (r.en, r.vi) for r in
           reviews.prepare_parallel_text(spark, en, vi).collect()}
    assert out == {0: ("hello world", "xin chào"), 1: ("its now", "bây giờ là giờ"),
                   2: ("hello world", "chào thế giới")}
