from fixtures import render
from gleanframe.plans.run import arguments, run
from gleanframe.sources.csv_table import read_csv_table

SF = "/root/testdata/sf0.001"


def test_flows_write_their_tables(spark, tmp_path):
    p, d, a, s = (str(tmp_path / n) for n in "pdas")
    render.listing_payloads(spark, SF).write.parquet(p)
    render.detail_pages(spark, SF).write.parquet(d)
    render.account_pages(spark, SF).write.parquet(a)
    spark.read.parquet(d).selectExpr("url", "1 as attempt", "html").write.parquet(s)
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")

    run(spark, arguments(["rent", "--payloads", p, "--pages", d, "--out", out, "--site", render.SITE,
                          "--stat-phrase", render.STAT_PHRASE, "--header", "time_on_site=since"]))
    rent = read_csv_table(spark, out)
    n_rent = rent.count()
    assert len(rent.columns) == 22 and "since" in rent.columns and n_rent > 100

    run(spark, arguments(["sale", "--payloads", p, "--pages", s, "--out", out, "--site", render.SITE]))
    sale = read_csv_table(spark, out)
    assert len(sale.columns) == 16 and sale.count() > n_rent

    run(spark, arguments(["account", "--pages", a, "--out", out, "--rejects", bad]))
    assert read_csv_table(spark, out).count() + read_csv_table(spark, bad).count() == 200
