"""Importers and remote lines against a server of this test, which breaks connections where it is told to."""

import gzip
import io
import json
import tarfile
import threading
import zipfile
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
import zstandard

from weftline.sources import files, importers, remote

SRC, TRG = [f"line {i} of a sid\x85e" for i in range(3000)], [f"Zeile {i}" for i in range(3000)]
FAST = {"tries": 3, "timeout": 5, "wait": 0.01}


def _lines(x):
    return ("\n".join(x) + "\n").encode()


def _zip(pair, a, b):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for lang, x in zip(pair.split("-"), (a, b), strict=True):
            z.writestr(f"Books.{pair}.{lang}", _lines(x))
    return out.getvalue()


def _tar(members):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as t:
        for name, x in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(_lines(x))
            t.addfile(info, io.BytesIO(_lines(x)))
    return out.getvalue()


FILES = {
    "/a.en.gz": gzip.compress(_lines(SRC[:1000])) + gzip.compress(_lines(SRC[1000:])),
    "/a.de.zst": zstandard.compress(_lines(TRG)),
    "/plain.txt": _lines(SRC),
    "/deaf/plain.txt": _lines(SRC),
    "/typed": gzip.compress(_lines(SRC)),
    "/short.txt": _lines(SRC[:7]),
    "/de-en.txt.zip": _zip("de-en", TRG, SRC),
    "/flores.tar.gz": _tar({"flores101_dataset/dev/eng.dev": SRC[:9], "flores101_dataset/dev/zho_simpl.dev": TRG[:9]}),
    "/empty.txt": b"",
}


@pytest.fixture(scope="module")
def server():
    broken = {}

    class Handler(BaseHTTPRequestHandler):
        def log_message(self, *_):
            pass

        def do_HEAD(self):
            self.answer(False)

        def do_GET(self):
            self.answer(True)

        def answer(self, body):
            path = self.path.split("?")[0]
            data = FILES.get(path)
            if data is None:
                return self.send_error(404)
            first, last = 0, len(data) - 1
            asked = None if path.startswith("/deaf") else self.headers.get("Range")
            if asked:
                a, b = asked.removeprefix("bytes=").split("-")
                first, last = int(a), int(b) if b else last
            self.send_response(206 if asked else 200)
            self.send_header("Content-Length", str(last + 1 - first))
            if path == "/typed":
                self.send_header("Content-Type", "application/gzip")
            self.end_headers()
            if body:
                part = data[first : last + 1]
                if broken.get(path, 0) > 0:
                    broken[path] -= 1
                    part = part[: len(part) // 2]
                self.wfile.write(part)

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_address[1]}", broken
    s.shutdown()


def texts(df):
    return [r.text for r in df.orderBy("line_no").collect()]


@pytest.mark.parametrize(("path", "want"), [("/a.en.gz", SRC), ("/a.de.zst?download=1", TRG), ("/plain.txt", SRC), ("/typed", SRC), ("/empty.txt", [])])
def test_remote_lines(spark, server, path, want):
    assert texts(remote.read(spark, server[0] + path, **FAST)) == want


@pytest.mark.parametrize("path", ["/plain.txt", "/a.en.gz", "/deaf/plain.txt", "/de-en.txt.zip"])
def test_broken_connections_are_taken_up(spark, server, path):
    server[1][path] = 2
    assert texts(remote.read(spark, server[0] + path, "Books.de-en.en" if path.endswith("zip") else None, **FAST)) == SRC


def test_given_up(server):
    server[1]["/plain.txt"] = 99
    with pytest.raises(remote.DownloadError):
        list(remote.text_lines(server[0] + "/plain.txt", **FAST))
    server[1]["/plain.txt"] = 0
    with pytest.raises(remote.DownloadError):
        list(remote.text_lines(server[0] + "/none", tries=3, wait=60))


def test_probes(spark, server, tmp_path):
    assert remote.exists(spark, server[0] + "/plain.txt")
    assert not remote.exists(spark, server[0] + "/none")
    assert not remote.exists(spark, str(tmp_path / "none"))
    assert remote.size(server[0] + "/short.txt") == len(_lines(SRC[:7]))


def test_parallel_importers(spark, server):
    base = server[0]
    reversed_pair = {f"{importers.OPUS.format(name='Books/v1')}/moses/{p}.txt.zip": f"{base}/{p}.txt.zip" for p in ("en-de", "de-en")}
    rows = importers.parallel(spark, "opus_Books/v1", "en", "de", reversed_pair, **FAST).orderBy("pos").collect()
    assert [(r.src, r.trg) for r in rows] == list(zip(SRC, TRG, strict=True))
    rows = importers.parallel(spark, "flores_dev", "en", "zh", {importers.FLORES: f"{base}/flores.tar.gz"}, **FAST).orderBy("pos").collect()
    assert [(r.src, r.trg) for r in rows] == list(zip(SRC[:9], TRG[:9], strict=True))
    with pytest.raises(importers.NotFoundAnywhere):
        importers.parallel(spark, f"url_{base}/none.[LANG].gz", "en", "de")
    with pytest.raises(ValueError, match="no importer"):
        importers.parallel(spark, "ftp_x", "en", "de")
    fetch = lambda name, src, trg: (f"{base}/a.de.zst", f"{base}/a.en.gz") if src == "de" else None
    rows = importers.parallel(spark, "sacrebleu_wmt", "en", "de", fetchers={"sacrebleu": fetch}, **FAST).orderBy("pos").collect()
    assert [(r.src, r.trg) for r in rows] == list(zip(SRC, TRG, strict=True))
    with pytest.raises(Exception, match="streams differ in length"):
        importers.continuation(spark, f"{base}/plain.txt", f"{base}/short.txt", **FAST).collect()
    with pytest.raises(ValueError, match="both sides"):
        importers.continuation(spark, "a", "b", ("c", "", "d"))


def test_fetchers_try_again():
    calls = []

    def fetch(name, src, trg):
        calls.append((src, trg))
        if len(calls) < 3:
            raise OSError("busy")
        return "x.en", "x.de"

    assert importers.fetched(fetch, "x", "en", "de") == (importers.Side("x.en"), importers.Side("x.de"))
    assert calls == [("en", "de")] * 3


def test_names():
    assert importers.suffixes("OPUS-gnome-v1-eng-zho_CN", "zh", "en") == ("zho_CN", "eng")
    with pytest.raises(ValueError, match="are not"):
        importers.suffixes("OPUS-gnome-v1-eng-deu", "zh", "en")
    assert [importers.hplt_locale(x) for x in ("ru", "ko", "srp_Cyrl")] == ["rus_Cyrl", "kor_Hang", "srp_Cyrl"]


def test_mono_importers(spark, server, tmp_path):
    base = server[0]
    mocked = {importers.NEWS_CRAWL.format(lang="en", name="news.2020"): f"{base}/a.en.gz"}
    some = importers.mono(spark, "news-crawl_news.2020", "en", 100, mocked, **FAST)
    got = [r.text for r in some.collect()]
    assert len(got) == 100 and set(got) <= set(SRC)
    assert got == [r.text for r in importers.mono(spark, "news-crawl_news.2020", "en", 100, mocked, **FAST).collect()]
    docs = [{"lang": ["eng_Latn"], "doc_scores": [s], "seg_langs": ["eng_Latn", "eng_Latn", "deu_Latn"], "text": f"one {s}\ntwo {s}\ndrei"} for s in (9.0, 4.0, 7.0)]
    for i in (1, 2):
        (tmp_path / f"{i}.jsonl").write_text("".join(json.dumps(d) + "\n" for d in docs[i - 1 :: 2]))
    (tmp_path / "map.txt").write_text("https://x/1.jsonl\n\nhttps://x/2.jsonl\n")
    mocked = {importers.HPLT.format(locale="eng_Latn"): str(tmp_path / "map.txt")} | {f"https://x/{i}.jsonl": str(tmp_path / f"{i}.jsonl") for i in (1, 2)}
    got = {r.text for r in importers.mono(spark, "hplt_mono/v2.0", "en", 10, mocked).collect()}
    assert got == {"one 9.0 two 9.0", "one 7.0 two 7.0"}
    with pytest.raises(ValueError, match="2.0"):
        importers.mono(spark, "hplt_mono/v1.0", "en", 10)


def test_local_archives(spark, tmp_path):
    (tmp_path / "f.tar.gz").write_bytes(FILES["/flores.tar.gz"])
    assert texts(files.read_lines(spark, str(tmp_path / "f.tar.gz"), "flores101_dataset/dev/eng.dev")) == SRC[:9]
