"""Command line: backfill, run-month, report and export against one store."""

from __future__ import annotations

import os
import shutil

from marquee.__main__ import main
from marquee.sources.export import write_csv
from tests.conftest import raw_row


def test_cli_round(spark, make_raw, tmp_path, capsys):
    raw = make_raw([raw_row("a", date_added="January 3, 2021", country="C1, C2"),
                    raw_row("b", date_added="February 3, 2021", type="TV Show", duration="2 Seasons"),
                    raw_row("c", date_added="March 3, 2021")])
    src = f"file://{tmp_path}/raw"
    write_csv(raw, src)
    store = f"file://{tmp_path}/store"
    assert main(["backfill", "--raw", f"{src}/*.csv", "--store", store, "--first", "2021-01",
                 "--last", "2021-02"]) == 0
    assert main(["run-month", "--raw", f"{src}/*.csv", "--store", store, "--month", "2021-03"]) == 0
    assert main(["report", "--store", store, "--name", "b3_tv_share"]) == 0
    out = capsys.readouterr().out
    assert "published version 1" in out and "published version 2" in out and "tv_show_share_pct" in out
    assert main(["report", "--store", store, "--all", "--out", f"file://{tmp_path}/reports"]) == 0
    assert len([d for d in os.listdir(tmp_path / "reports") if d.endswith(".csv")]) == 25
    assert main(["export", "--store", store, "--out", f"file://{tmp_path}/bi"]) == 0
    assert sorted(os.listdir(tmp_path / "bi")) == ["genres.csv", "title_countries.csv", "titles.csv",
                                                 "yearly_summary.csv"]


def test_cli_stream_and_prune(spark, make_raw, tmp_path, capsys):
    src = f"file://{tmp_path}/incoming"
    write_csv(make_raw([raw_row("a", date_added="January 3, 2021"),
                        raw_row("b", date_added="February 3, 2021")]), src)
    store = f"file://{tmp_path}/store"
    ckpt = f"file://{tmp_path}/ckpt"
    assert main(["stream", "--source", src, "--store", store, "--checkpoint", ckpt]) == 0
    write_csv(make_raw([raw_row("c", date_added="March 3, 2021")]), f"{src}/more")
    for f in os.listdir(tmp_path / "incoming" / "more"):
        if f.startswith("part-"):
            shutil.copy(tmp_path / "incoming" / "more" / f, tmp_path / "incoming" / f"late-{f}")
    assert main(["stream", "--source", src, "--store", store, "--checkpoint", ckpt]) == 0
    assert main(["compact", "--store", store]) == 0
    assert main(["prune", "--store", store, "--keep", "1"]) == 0
    out = capsys.readouterr().out
    assert "latest version 1" in out and "latest version 2" in out and "dropped versions [1, 2]" in out
