"""Archives, well made and hostile ones."""

import hashlib
import io
import os
import tarfile
import zipfile

import pytest

from weftgraph.sources import archives

TREE = {"src/a.c": b"int a;\n", "src/lib/z.c": b"\x00\xff", "src/b.c": b"", "README": b"hello", "src/é x.h": b"h" * 3000}


def zipped(path, entries):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in entries:
            z.writestr(name, data)


def tarred(path, entries, mode="w:gz"):
    with tarfile.open(path, mode) as t:
        for name, data in entries:
            member = tarfile.TarInfo(name)
            if isinstance(data, bytes):
                member.size = len(data)
                t.addfile(member, io.BytesIO(data))
            else:
                member.type, member.linkname = data[0], "/etc/passwd"
                t.addfile(member)


def walked(tree, root):
    for name, data in tree.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    state = hashlib.sha256()
    for folder, folders, names in os.walk(root):
        folders.sort()
        for name in sorted(names):
            path = os.path.join(folder, name)
            state.update(os.path.relpath(path, root).encode())
            state.update(open(path, "rb").read())
    return state.hexdigest()


def read(spark, folder, **most):
    found = archives.members(spark, str(folder), **most).collect()
    return {os.path.basename(r.archive): r.error for r in found if r.error}, {(os.path.basename(r.archive), r.path): bytes(r.content) for r in found if r.error is None}


def test_files_and_digest_are_those_of_the_tree(spark, tmp_path):
    up = tmp_path / "up load"
    up.mkdir()
    zipped(up / "a.zip", [("README", b"old"), ("src/", b""), *TREE.items()])
    tarred(up / "b.TGZ", [("README", b"old"), ("src", (tarfile.DIRTYPE,)), ("pipe", (tarfile.FIFOTYPE,)), *TREE.items()])
    tarred(up / "c.tar", [("./src/../" + k, v) for k, v in TREE.items()], "w")
    zipped(up / "empty.zip", [])
    errors, files = read(spark, up)
    assert not errors
    for name in ("a.zip", "b.TGZ", "c.tar"):
        assert {p: c for (a, p), c in files.items() if a == name} == TREE
    assert {a for a, _ in files} == {"a.zip", "b.TGZ", "c.tar"}
    got = archives.digests(archives.files(archives.members(spark, str(up)))).collect()
    assert len(got) == 3 and {r.digest for r in got} == {walked(TREE, tmp_path / "tree")}


def test_hostile_archives_are_refused(spark, tmp_path):
    most = {"most_files": 6, "most_bytes": 10_000}
    zipped(tmp_path / "out.zip", [("a", b"1"), ("../b", b"2")])
    zipped(tmp_path / "absolute.zip", [("/etc/x", b"2")])
    tarred(tmp_path / "out.tar.gz", [("a/../../b", b"2")])
    tarred(tmp_path / "soft.tgz", [("x", (tarfile.SYMTYPE,))])
    tarred(tmp_path / "hard.tar", [("x", (tarfile.LNKTYPE,))], "w")
    link = zipfile.ZipInfo("x")
    link.external_attr = 0o120777 << 16
    zipped(tmp_path / "soft.zip", [(link, b"/etc/passwd")])
    zipped(tmp_path / "many.zip", [(str(i), b"") for i in range(7)])
    tarred(tmp_path / "many.tar", [(str(i), b"") for i in range(7)], "w")
    zipped(tmp_path / "bomb.zip", [("a", b"0" * 6000), ("b", b"0" * 6000)])
    tarred(tmp_path / "bomb.tgz", [("a", b"0" * 6000), ("b", b"0" * 6000)])
    (tmp_path / "torn.zip").write_bytes(b"PK\x03\x04 no archive")
    (tmp_path / "torn.tgz").write_bytes((tmp_path / "out.tar.gz").read_bytes()[:20])
    (tmp_path / "notes.rar").write_bytes(b"x")
    zipped(tmp_path / "fine.zip", [("d/", b""), *((f"d/{i}", b"0" * 2000) for i in range(5))])
    errors, files = read(spark, tmp_path, **most)
    want = {"out.zip": "leads out", "absolute.zip": "leads out", "out.tar.gz": "leads out", "soft.tgz": "links", "hard.tar": "links", "soft.zip": "links", "many.zip": "members"}
    want |= {"many.tar": "members", "bomb.zip": "bytes", "bomb.tgz": "bytes", "torn.zip": "readable", "torn.tgz": "readable", "notes.rar": "format"}
    assert errors.keys() == want.keys() and all(part in errors[name] for name, part in want.items())
    assert {a for a, _ in files} == {"fine.zip"} and len(files) == 5
    assert archives.files(archives.members(spark, str(tmp_path), **most)).count() == 5


@pytest.mark.parametrize("name, path", [("a", "a"), ("a/../b", "b"), ("./", ""), ("..", None), ("a/../../b", None), ("/a", None), ("..a", "..a"), ("a\0b", "a\0b")])
def test_paths(name, path):
    assert archives.inside(name) == path
