"""The command line: a batch run and a legacy dictionary import."""

import json
import os

from cdrflow.__main__ import main

import cdr_fixtures as fx


def test_cli_batch_and_import(spark, tmp_dir, capsys):
    landing = fx.build_landing(os.path.join(tmp_dir, "landing"))
    wh = os.path.join(tmp_dir, "wh")
    legacy = os.path.join(tmp_dir, "old")
    os.makedirs(os.path.join(legacy, "idc", "user"))
    os.makedirs(os.path.join(legacy, "idc", "page"))
    with open(os.path.join(legacy, "idc", "user", "1"), "w") as fh:
        fh.write(f"7;idc;alphanet;{fx.BERT};{fx.IMSI[fx.BERT]};\n")
    with open(os.path.join(legacy, "idc", "page", "1"), "w") as fh:
        fh.write(f"40;{fx.MENU}/balance.xml\n")
    main(["import-dims", "--legacy", legacy, "--warehouse", wh])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"users": 1, "pages": 1, "unreadable": 0}
    main(["batch", "--landing", landing, "--warehouse", wh, "--batch-id", "5", "--no-text"])
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert res["standard_rows"] == fx.STANDARD_ROWS
    # the imported subscriber and page keep their ids; the rest continue after them
    assert res["new_users"] == fx.USERS - 1 and res["new_pages"] == fx.PAGES - 1
    users = {r["msisdn"]: r["user_id"] for r in spark.read.parquet(os.path.join(wh, "dim_user")).collect()}
    assert users[fx.BERT] == 7 and min(v for k, v in users.items() if k != fx.BERT) == 8
    pages = {r["url"]: r["page_id"] for r in spark.read.parquet(os.path.join(wh, "dim_page")).collect()}
    assert pages[f"{fx.MENU}/balance.xml"] == 40 and sorted(pages.values())[:1] == [40]
