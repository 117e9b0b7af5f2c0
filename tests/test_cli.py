from lodestrata.__main__ import main


def test_commands(spark, tmp_path, capsys):
    docs = tmp_path / "docs"
    docs.mkdir()
    body = "It was the laminar vortex and then the resonant cavity or the plastic magnet that counted in each of the runs made here. " * 3
    (docs / "a.md").write_text("# One\n" + body)
    root = ["--root", str(tmp_path / "store")]
    assert main([*root, "ingest", str(docs)]) == 0 and capsys.readouterr().out.strip() == "new: 1"
    assert main([*root, "search", "plastic magnet", "--n", "1"]) == 0 and "plastic magnet" in capsys.readouterr().out
    assert main([*root, "search", "laminar vortex", "--mode", "map"]) == 0 and "resonant cavity" in capsys.readouterr().out
    assert main([*root, "search", "laminar vortex", "--mode", "graph"]) == 0 and "expanded by:" in capsys.readouterr().out
    assert main([*root, "check", str(docs)]) == 0
    (docs / "b.txt").write_text("new")
    assert main([*root, "check", str(docs)]) == 1
