"""AWS signature version 4, by its public specification."""

from __future__ import annotations

import hashlib
import hmac
from urllib.parse import parse_qsl, quote, urlsplit


def _hash(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def sign(method: str, url: str, headers: dict[str, str], payload: bytes, access_key: str, secret: str, region: str, service: str, stamp: str, token: str | None = None) -> dict[str, str]:
    """The headers of the signed request.  ``stamp``: ``yyyyMMddTHHmmssZ``."""
    u = urlsplit(url)
    sent = {k.lower().strip(): " ".join(str(v).split()) for k, v in headers.items()} | {"host": u.netloc, "x-amz-date": stamp}
    if token:
        sent["x-amz-security-token"] = token
    if service == "s3":
        sent["x-amz-content-sha256"] = _hash(payload)
    names = sorted(sent)
    path = quote(u.path or "/", safe="/-_.~%")
    query = "&".join(f"{quote(k, safe='-_.~')}={quote(v, safe='-_.~')}" for k, v in sorted(parse_qsl(u.query, keep_blank_values=True)))
    request = "\n".join([method.upper(), path, query, *(f"{n}:{sent[n]}" for n in names), "", ";".join(names), _hash(payload)])
    scope = f"{stamp[:8]}/{region}/{service}/aws4_request"
    text = "\n".join(["AWS4-HMAC-SHA256", stamp, scope, _hash(request.encode())])
    key = ("AWS4" + secret).encode()
    for part in scope.split("/"):
        key = hmac.new(key, part.encode(), hashlib.sha256).digest()
    signature = hmac.new(key, text.encode(), hashlib.sha256).hexdigest()
    sent["authorization"] = f"AWS4-HMAC-SHA256 Credential={access_key}/{scope}, SignedHeaders={';'.join(names)}, Signature={signature}"
    return sent
