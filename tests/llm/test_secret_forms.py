"""Forms in which keys stand in texts."""

import base64
import json

from cohortviews.llm import secret_scan


def _der(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x81, n]) if n < 256 else bytes([0x82]) + n.to_bytes(2, "big")
    return bytes([tag]) + size + body


RSA = _der(0x30, _der(2, b"\0") + _der(2, b"\x7f" * 129) + _der(2, b"\1\0\1") + _der(2, b"\xff" * 128))
SSH = b"".join(len(x).to_bytes(4, "big") + x for x in (b"ssh-rsa", b"\1\0\1", b"\x55" * 129))


def _b64(data):
    return base64.b64encode(data).decode()


def _lines(data, size=64):
    run = _b64(data)
    return [run[i : i + size] for i in range(0, len(run), size)]


def _kinds(text):
    return [k for _, _, k in secret_scan.scan(text)]


def test_bare_keys_behind_an_equals_sign():
    for data, kind in ((RSA, "der"), (SSH, "ssh")):
        run = _b64(data)
        for before in ("private_key=", "private_key: ", "x==", r"PEM\n", r"a\r\n"):
            assert secret_scan.scan(before + run + " x") == [(len(before), len(before) + len(run), kind)]
        assert _kinds("a" + run) == _kinds("n" + run) == []
    assert _kinds("token=" + _b64(RSA)) == ["assign", "der"]


def test_armour_with_escaped_line_breaks():
    parts = ["-----BEGIN RSA PRIVATE KEY-----", *_lines(RSA), "-----END RSA PRIVATE KEY-----"]
    assert "/" in _b64(RSA)
    real = "\n".join(parts) + "\n"
    forms = [real, "\r\n".join(parts), "".join(parts), "\\\n".join(parts)]
    forms += [json.dumps(real)[1:-1], json.dumps(json.dumps(real))[3:-3], json.dumps(real)[1:-1].replace("/", r"\/"), r"\u000a".join(parts)]
    forms += [r"\r\n".join(parts)]
    for form in forms:
        found = [x for x in secret_scan.scan("é " + form + " x") if x[2] == "pem"]
        end = 2 + form.index("-----END") + len(parts[-1])
        assert found == [(2, end, "pem")], form
    account = json.dumps({"type": "service_account", "private_key": real})
    start = account.index("-----BEGIN")
    assert (start, account.index("-----END") + len(parts[-1]), "pem") in secret_scan.scan(account)
    assert _kinds(r"\n".join([parts[0], *_lines(RSA[:-1]), parts[-1]])) == []
    assert _kinds(r"\n".join([parts[0], "not base 64 !", parts[-1]])) == []


def test_masking_takes_the_whole_escaped_key(spark):
    text = json.dumps({"k": "\n".join(["-----BEGIN PRIVATE KEY-----", *_lines(RSA), "-----END PRIVATE KEY-----"])})
    docs = spark.createDataFrame([(1, text), (2, "private_key=" + _b64(RSA))], "doc_id long, text string")
    assert {r.doc_id: r.text for r in secret_scan.masked(docs).collect()} == {1: '{"k": "<pem>"}', 2: "private_key=<der>"}


def _url(data):
    return base64.urlsafe_b64encode(data).decode().rstrip("=")


def test_encrypted_keys():
    oid, salt = bytes.fromhex("06092a864886f70d01050d"), _der(0x30, _der(4, b"saltsalt") + _der(2, b"\x08\0"))
    locked = _der(0x30, _der(0x30, oid + salt) + _der(4, b"\x99" * 96))
    digest = _der(0x30, _der(0x30, bytes.fromhex("0609608648016503040201") + _der(5, b"")) + _der(4, b"\x99" * 32))
    armour = lambda name, lines: "\n".join([f"-----BEGIN {name} KEY-----", *lines, f"-----END {name} KEY-----"])
    assert _kinds(armour("ENCRYPTED PRIVATE", _lines(locked))) == ["pem", *["der"] * (len(_lines(locked)) == 1)]
    assert _kinds(_b64(locked)) == ["der"] and _kinds(_b64(digest)) == []
    headers = ["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC," + "0A" * 16, ""]
    for lines, kinds in (([*headers, *_lines(b"\x99" * 160)], ["pem"]), ([*headers, *_lines(b"\x99" * 161)], [])):
        assert _kinds(armour("RSA PRIVATE", lines)) == kinds
        assert _kinds(json.dumps(armour("RSA PRIVATE", lines))) == kinds
    assert _kinds(armour("RSA PRIVATE", _lines(b"\x99" * 160))) == []
    assert _kinds(armour("RSA PRIVATE", ["Comment: mine", "", *_lines(RSA)])) == ["pem"]


def test_token_headers_with_white_space_and_hex_of_ssh_keys():
    for header in (b'{"alg":"HS256"}', b'{ "alg": "HS256"}', b'{\n "alg": "HS256"}', b' {"alg":"HS256"}', b'\n{"alg":"HS256"}'):
        token = ".".join([_url(header), _url(b'{"sub":1}'), _url(b"sig" * 8)])
        for before in ("", "example.", "Cookie=", "Dear.friend.", r"\n", "https://x/"):
            assert secret_scan.scan(before + token) == [(len(before), len(before) + len(token), "jwt")]
    assert _kinds(".".join([_url(b'{ "a": 1}'), _url(b"{}"), "c2ln"])) == _kinds("e.g. Dear.friend.of Item.Cell.End") == []
    assert "ssh" in _kinds(SSH.hex()) and _kinds(SSH.hex().upper()) == ["ssh", "hex"] and "ssh" not in _kinds((SSH + b"\0").hex())
