import bz2
import gzip
import json
import zlib

import pytest
from pyspark.sql import functions as F

from vacancia import schema as S
from vacancia.operators import standardise as N
from vacancia.sources import csv_files, json_payloads, sinks, web_pages


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_tree_maps_each_files_own_header(spark, tmp_path):
    write(tmp_path / "shine" / "a.csv", 'title,company,salary\n"Dev, ""Sr""",Acme,5\n')
    write(tmp_path / "shine" / "b.csv", "Salary,companyName,Title\n6,Beta,Ops\n")
    write(tmp_path / "foundit" / "c.csv", 'jobTitle ,apply_url,description\nQA,http://x,"two\nlines"\n')
    rows, bad, headers = csv_files.read_tree(spark, f"file://{tmp_path}", N.standardise_silver)
    got = {r.job_title: r for r in rows.collect()}
    assert got['Dev, "Sr"'].company == "Acme" and got['Dev, "Sr"'].source == "shine"
    assert (got["Ops"].company, got["Ops"].salary) == ("Beta", "6")
    assert got["QA"].job_url == "http://x" and got["QA"].description == "two\nlines"
    assert bad.count() == 0 and headers.count() == 3


def test_bad_files_and_rows_are_recorded_not_fatal(spark, tmp_path):
    write(tmp_path / "p" / "good.csv", "title,company\na,b\nc,d,e\n")
    write(tmp_path / "p" / "empty.csv", "\n")
    (tmp_path / "p" / "binary.csv").write_bytes(b"\xff\xfe\xfa\x00")
    rows, bad, headers = csv_files.read_tree(spark, f"file://{tmp_path}", N.standardise_silver)
    audit = {r.file_name: r for r in csv_files.file_audit(headers, rows, bad).collect()}
    assert audit["good.csv"].raw_count == 1 and audit["good.csv"].bad_rows == 1
    assert audit["good.csv"].status == "success" and audit["good.csv"].columns == 2
    assert audit["empty.csv"].status.startswith("failed") and audit["binary.csv"].status.startswith("failed")
    assert bad.first().record == "c,d,e"


def test_headers_and_rows_of_any_length(spark, tmp_path):
    write(tmp_path / "p" / "bom.csv", "\ufefftitle,company\nT1,A\n")
    write(tmp_path / "p" / "twice.csv", "Title,title\nT2,x\nT3,\n")
    write(tmp_path / "p" / "short.csv", "title,company,salary\nT4,B\nT5\n")
    write(tmp_path / "p" / "wide.csv", "title," + ",".join(f"\u20b9{i:05d}" for i in range(15000)) + "\nT6,1\n")
    write(tmp_path / "p" / "long.csv", "title,salary\n" + "T7,\u20b9\u20b9\u20b9\n" * 9000)
    write(tmp_path / "p" / "one.csv", 'title\nT8\n"T9, ""q"""\n')
    (tmp_path / "p" / "latin.csv").write_bytes("title,company\nT10,caf\xe9\nT11,ok\n".encode("latin-1"))
    for multi_line in (True, False):
        rows, bad, headers = csv_files.read_tree(spark, f"file://{tmp_path}", N.standardise_silver, multi_line)
        titles = {r.job_title: r["count"] for r in rows.groupBy("job_title").count().collect()}
        assert titles == {"T1": 1, "T2": 1, "T3": 1, "T4": 1, "T5": 1, "T6": 1, "T7": 9000, "T8": 1, 'T9, "q"': 1, "T11": 1}
        audit = {r.file_name: r for r in csv_files.file_audit(headers, rows, bad).collect()}
        assert all(r.status == "success" for r in audit.values()) and audit["latin.csv"].bad_rows == 1
        assert audit["wide.csv"].columns == 15001 and bad.count() == 1


def test_a_broken_compressed_file_fails(spark, tmp_path):
    whole = gzip.compress(b"a\n" + b"x1234\n" * 20000)
    (tmp_path / "x.csv.gz").write_bytes(whole[:len(whole) // 2])
    with pytest.raises(Exception):
        csv_files.read_or_gz(spark, f"file://{tmp_path}/x.csv", S.strings(["a"])).count()


@pytest.mark.parametrize("multi_line", [True, False])
def test_broken_compressed_files_are_recorded_not_fatal(spark, tmp_path, multi_line):
    folder = tmp_path / "p"
    write(folder / "plain.csv", "title,company\na,b\n")
    lines = "title,company\n" + "".join(f"t{i},c{i * 7919}\n" for i in range(20000))
    (folder / "whole.csv.gz").write_bytes(gzip.compress(lines.encode()))
    (folder / "whole.csv.bz2").write_bytes(bz2.compress(b"company,title\nB,T\n"))
    (folder / "whole.csv.deflate").write_bytes(zlib.compress(lines.encode()))
    (folder / "cut.csv.gz").write_bytes(gzip.compress(lines.encode())[:30000])
    (folder / "cut.csv.deflate").write_bytes(zlib.compress(lines.encode())[:30000])
    (folder / "not.csv.gz").write_bytes(b"title,company\na,b\n")
    rows, bad, headers = csv_files.read_globs(spark, [f"file://{tmp_path}/*/*.csv*"], N.standardise_silver, multi_line=multi_line)
    audit = {r.file_name: r for r in csv_files.file_audit(headers, rows, bad).collect()}
    assert {n for n, r in audit.items() if r.status.startswith("failed: ")} == {"cut.csv.gz", "cut.csv.deflate", "not.csv.gz"}
    assert {n: r.raw_count for n, r in audit.items() if r.raw_count} == {
        "plain.csv": 1, "whole.csv.gz": 20000, "whole.csv.bz2": 1, "whole.csv.deflate": 20000}
    assert bad.count() == 0 and audit["cut.csv.gz"].columns == 0


def test_records_are_cut_without_python(spark, tmp_path):
    write(tmp_path / "p" / "a.csv", 'title,"com""pany", salary\n"a ""x"", y",,"1\n2"\n,"",\n b ,c\nd,e,f,\nlone\nx,"open,y\n')
    write(tmp_path / "p" / "b.csv", 'title\n"q,r"\n\n  s\n')
    records = csv_files.read_records(spark, [f"file://{tmp_path}/*/*.csv"])
    headers = csv_files.file_headers(csv_files.list_files(spark, f"file://{tmp_path}/*/*.csv"), records)
    names = {r.path[-5:]: r.header for r in headers.collect()}
    assert names == {"a.csv": ["title", 'com"pany', " salary"], "b.csv": ["title"]}
    body = records.filter(~F.col("record").startswith("title") | F.col("record").isNull()).withColumns(
        {"width": F.when(F.col("file_path").endswith("a.csv"), 3).otherwise(1), "header_id": F.lit(7)})
    cut = csv_files._cut_all(body)
    assert "Python" not in cut._jdf.queryExecution().toString() and "MapIn" not in headers._jdf.queryExecution().toString()
    got = sorted(((r.file_path[-5:], r.header_id, r.fields, r.record) for r in cut.collect()), key=str)
    assert got == sorted([
        ("a.csv", 7, ['a "x", y', None, "1\n2"], None), ("a.csv", 7, [None, None, None], None), ("a.csv", 7, [" b ", "c"], None),
        ("a.csv", -1, None, "d,e,f,"), ("a.csv", 7, ["lone"], None), ("a.csv", -1, None, 'x,"open,y'),
        ("b.csv", 7, ["title"], None), ("b.csv", 7, ["q,r"], None), ("b.csv", 7, ["  s"], None)], key=str)


def test_source_reads_batches_and_skips_samples(spark, tmp_path):
    write(tmp_path / "s" / "batches" / "s_1.csv", "job_id,title\n1,a\n")
    write(tmp_path / "s" / "master.csv", "job_id,title\n2,b\n")
    write(tmp_path / "s" / "My_SAMPLE.csv", "job_id,title\n3,c\n")
    rows, _, headers = csv_files.read_source(spark, f"file://{tmp_path}", "s", N.standardise_master)
    assert headers.count() == 2
    assert sorted(r.job_id for r in rows.collect()) == ["1", "2"]
    assert {r.source for r in rows.collect()} == {"s"}


def test_missing_source_is_an_empty_frame(spark, tmp_path):
    rows, bad, _ = csv_files.read_source(spark, f"file://{tmp_path}", "none", N.standardise_master)
    assert rows.count() == 0 and rows.columns[:2] == ["job_id", "title"] and bad.count() == 0


def test_gz_fallback_order(spark, tmp_path):
    schema = S.strings(["a"])
    with gzip.open(tmp_path / "x.csv.gz", "wt") as f:
        f.write("a\nzipped\n")
    path = f"file://{tmp_path}/x.csv"
    assert csv_files.read_or_gz(spark, path, schema).first().a == "zipped"
    write(tmp_path / "x.csv", "a\nplain\n")
    assert csv_files.read_or_gz(spark, path, schema).first().a == "plain"
    assert csv_files.read_or_gz(spark, f"file://{tmp_path}/y.csv", schema).count() == 0


def payloads(spark, *objects):
    return spark.createDataFrame([(json.dumps(o),) for o in objects], "payload string")


def test_foundit_payload(spark):
    item = {"jobId": 7, "title": " Dev ", "companyName": "A", "locations": ["Pune", "Goa"], "skills": "sql",
            "minimumExperience": {"years": 2}, "maximumSalary": {"absoluteValue": 9.5}}
    data = ["text", None, {"title": ""}, {"jobId": 1}, item]
    rows = json_payloads.foundit_rows(payloads(spark, {"jobSearchResponse": {"data": data}}, {"other": 1})).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.job_id, row.title, row.location, row.skills) == ("7", "Dev", "Pune, Goa", "sql")
    assert row.experience == "2 - None" and row.min_exp == 2.0 and row.max_salary == 9.5


def test_shine_payload(spark):
    item = {"id": 1, "jJT": "Dev", "jKwd": ["a", "b"], "jJD": "<p>x<b>y</b></p>"}
    row = json_payloads.shine_rows(payloads(spark, {"results": [item]})).first()
    assert (row.job_id, row.skills, row.description, row.company) == ("1", "a, b", "x y", None)


def test_remoteok_payload_drops_metadata(spark):
    rows = json_payloads.remoteok_rows(
        payloads(spark, [{"legal": "x"}, {"id": "1", "position": "Dev", "tags": ["a", "b"], "salary_min": 10}, {"id": "2"}])
    ).collect()
    assert [(r.job_id, r.skills, r.salary_min) for r in rows] == [("1", "a,b", 10.0), ("2", "", None)]


PAGE = """<html><div class="container individual_internship visible" internshipid="42">
<a class="job-title-href" href="/job/42"> Data &amp; BI </a><p class="company-name"> Acme </p>
<p class="row-1-item locations"><span><a>Pune</a></span></p>
<div class="about_job"><div class="text">Build <b>things</b></div></div>
<div class="individual_internship_header"><div class="job_skill wide"><span>Power</span> BI</div></div>
<div class="individual_internship_details">x</div><div class="job_skill">SQL</div><div class="no_job_skills">no</div><div class="job_skill"> Excel </div>
<div class="status-inactive"><i></i><span>2 days ago</span></div></div>
<div class="individual_internship" internshipid="43"></div></html>"""


def test_page_cards(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "<html></html>")], "page_id int, html string")
    rows = web_pages.card_fields(web_pages.page_cards(pages, "html")).orderBy("job_id").collect()
    first, empty = rows
    assert (first.job_id, first.job_title, first.company, first.location) == ("42", "Data & BI", "Acme", "Pune")
    assert first.skills == "Power BI,SQL,Excel" and first.description == "Build things"
    assert first.posted_date == "2 days ago" and first.job_url == "https://internshala.com/job/42"
    assert (empty.job_id, empty.job_title, empty.skills, empty.job_url) == ("43", None, "", "")


def test_card_lines_order_and_quirks(spark):
    text = "Dev\nAcme Company\n0-2 Yrs\n3 years\nPune\n\nnice work\nsql, python\n2 Days Ago"
    row = web_pages.card_lines(spark.createDataFrame([(text,)], "t string"), "t").first()
    assert (row.title, row.company, row.experience) == ("Dev", "Acme Company", "0-2 Yrs")
    assert row.salary == "Acme Company"  # "pa" sits in "company"
    assert row.location == "Pune" and row.posted_date == "2 Days Ago"
    assert row.skills == "sql, python" and row.description == "nice work"


def test_card_lines_posted_date_takes_the_last(spark):
    text = "Dev\nAcme\n1 day ago\n3 weeks\n1 week ago"
    row = web_pages.card_lines(spark.createDataFrame([(text,)], "t string"), "t").first()
    assert row.posted_date == "1 week ago" and row.skills == "3 weeks" and row.location is None


def test_batch_append_replaces_its_own_batch(spark, tmp_path):
    path = f"file://{tmp_path}/b"
    df = spark.createDataFrame([(" a ",)], "v string")
    for stamp in ("1", "2", "2"):
        sinks.append_batch(df, path, stamp)
    got = spark.read.option("header", True).csv(path)
    assert got.count() == 2 and got.first().v == " a "


def test_payload_items_are_parsed_once(spark):
    payloads = spark.createDataFrame([('{"jobSearchResponse":{"data":["x",{"title":""},null,{"jobId":"1","title":" a ","skills":["p","q"]},[1]]}}',),
                                      ("{}",), ("no json",), (None,)], "payload string")
    rows = json_payloads.foundit_rows(payloads)
    assert [(r.job_id, r.title, r.skills) for r in rows.collect()] == [("1", "a", "p, q")]
    # A filter on the title had the item parsed again beneath the projection.
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json(StructField(") == 2


def test_card_fields_of_odd_markup(spark):
    card = ('<p class="a > company-name">A&amp;B</p><a href="/q" class="job-title-href"><b>T</b> x</a>'
            '<p class="locations"></p>job_skill<div class="job_skill">s <i>1</i></div><div class="job_skill">s2</div>')
    row = web_pages.card_fields(spark.createDataFrame([(card,), ("",)], "card string")).collect()
    assert (row[0].company, row[0].job_title, row[0].location) == ("A&B", "T x", "")
    assert (row[0].skills, row[0].job_url) == ("s 1,s2", "https://internshala.com/q")
    assert row[0].posted_date is None and (row[1].job_title, row[1].skills, row[1].job_url) == (None, "", "")
    plan = web_pages.card_fields(spark.createDataFrame([(card,)], "card string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1  # only skills want every match


def test_records_meet_their_headers_without_a_shuffle(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"p{i}").mkdir()
        (tmp_path / f"p{i}" / "a.csv").write_text(f"title,c{i}\n" + "x,y\n" * 20_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50k")  # less than the files
    seen, cut_all = [], csv_files._cut_all
    try:
        csv_files._cut_all = lambda body: seen.append(body) or cut_all(body)
        rows, _, _ = csv_files.read_tree(spark, f"file://{tmp_path}", N.standardise_master)
        # The records were shuffled and sorted by path: the size of the headers was not known.
        assert "SortMergeJoin" not in seen[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        csv_files._cut_all = cut_all
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows.count() == 60_000


def test_scratch_tables_are_packed_closely(spark, tmp_path):
    """Landed records and stored tables are most of what a landing writes besides its files."""
    from vacancia.session import materialize

    write(tmp_path / "shine" / "a.csv", "title,company\nDev,Acme\n")
    rows, bad, headers = csv_files.read_tree(spark, f"file://{tmp_path}", N.standardise_silver)
    for table in (rows, headers, materialize(rows, "rows")):
        assert table.inputFiles() and all(f.endswith(".zstd.parquet") for f in table.inputFiles())


def test_pages_do_not_grow_with_the_tables(spark, monkeypatch):
    """src_html_cards: a page held all cards of a portal and company, of a seventeenth of all postings without one."""
    from vacancia.catalog import landing

    sf = "/root/testdata/sf0.001"

    def most():
        return landing.card_pages(spark, sf).select(F.max(F.size(F.split("html", "internshipid=")) - 1)).first()[0]

    whole = landing.src_html_cards(spark, sf)
    before = most()
    monkeypatch.setattr(landing, "PAGE_ORDERS", 100)
    after = landing.src_html_cards(spark, sf)
    assert before > 50 and most() < before / 5
    assert whole.count() == after.count() and whole.exceptAll(after).isEmpty()
