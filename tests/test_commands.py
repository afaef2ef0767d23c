"""The command line over files."""

import pytest

from faultline.__main__ import _parser, main
from faultline.plans import jobs

from test_ingest import event


def test_quakes_with_rejects_then_views(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join([event(unid="u1"), event(unid="u1"), "not json", event(lat=91.0)]))
    args = ["quakes", "--source", "text", "--path", f"{tmp_path}/in", "--table", f"{tmp_path}/out", "--once"]
    assert main([*args, "--checkpoint", f"{tmp_path}/cp", "--rejects", f"{tmp_path}/bad"]) == 0
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1
    reasons = {r.reject_reason for r in spark.read.parquet(f"{tmp_path}/bad").collect()}
    assert reasons == {"malformed_json", "out_of_range"}
    assert main(["view", "--table", f"{tmp_path}/out"]) == 0
    assert main(["schema", "--table", f"{tmp_path}/out"]) == 0
    capsys.readouterr()
    assert main(["view", "--table", f"{tmp_path}/absent"]) == 1
    assert "no table at" in capsys.readouterr().out


def test_coefficients_and_bounds():
    args = _parser().parse_args(
        ["intensity", "--quakes", "q", "--sites", "s", "--table", "t", "--pgv", "-1", "1", "2", "0.1", "--low", "0.2", "--method", "slc"]
    )
    assert args.pgv == [-1, 1, 2, 0.1] and args.pgd == [-3.0, 0.9, 1.3, 0.006]
    assert (args.low, args.moderate, args.method) == (0.2, 1.0, "slc")


def test_far_distances_are_asked_for(spark, tmp_path):
    with pytest.raises(ValueError, match="far=True"):
        jobs.find_proximity(spark, "q", "s", 20000.0, f"{tmp_path}/out", f"{tmp_path}/cp")
