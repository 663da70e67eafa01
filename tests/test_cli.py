import json
import os
import tempfile

from starweave.__main__ import main


def test_cli_load_and_query(spark, retail, capsys):
    root = tempfile.mkdtemp(prefix="sw-cli-")
    for t, df in retail.items():
        df.write.parquet(os.path.join(root, f"{t}.parquet"))
    import uuid
    db = "swcli_" + uuid.uuid4().hex[:8]
    assert main(["load", root, "--publish", db]) == 0
    assert spark.table(f"{db}.mv_monthly_sales").count() > 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["counts"]["fact_sales"] == 10 and all(out["summaries"].values())
    assert main(["query", out["star"], "monthly_recap"]) == 0
    assert "total_revenue" in capsys.readouterr().out


def test_catalogue_index_covers_every_query(capsys):
    from starweave.plans.catalogue import CATALOGUE, TITLES
    assert list(TITLES) == list(CATALOGUE)
    assert TITLES["monthly_recap"].startswith("1.") and TITLES["card_campaign"].startswith("61.")
    assert main(["list"]) == 0
    assert len(capsys.readouterr().out.strip().splitlines()) == len(CATALOGUE)


def test_cli_query_with_testdata_params(spark, tpch_star, capsys):
    assert main(["query", tpch_star.location, "drill_province", "--params", "testdata"]) == 0
    assert "NATION_" in capsys.readouterr().out
