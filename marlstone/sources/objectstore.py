"""Object-store connection settings from the environment.

Returns Hadoop S3A settings for the session builder; nothing is opened
here. The zone root is a plain URI, so ``file:/...`` roots need none of it.
No default credentials: a missing key is an error that names the variable.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

ENDPOINT_VAR = "AWS_ENDPOINT_URL"
ACCESS_KEY_VAR = "AWS_ACCESS_KEY_ID"
SECRET_KEY_VAR = "AWS_SECRET_ACCESS_KEY"


def _require(env: Mapping[str, str], name: str) -> str:
    value = env.get(name)
    if not value:
        raise KeyError(f"environment variable {name} is not set")
    return value


def object_store_conf(env: Mapping[str, str] | None = None) -> dict[str, str]:
    """S3A settings: endpoint, keys, path-style URLs, TLS from the scheme.

    ``AWS_ENDPOINT_URL`` is optional (absent = the provider's default
    endpoint); ``https://`` turns TLS on, ``http://`` turns it off.
    """
    env = os.environ if env is None else env
    conf = {
        "spark.hadoop.fs.s3a.access.key": _require(env, ACCESS_KEY_VAR),
        "spark.hadoop.fs.s3a.secret.key": _require(env, SECRET_KEY_VAR),
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
    endpoint = env.get(ENDPOINT_VAR)
    if endpoint:
        secure = endpoint.startswith("https://")
        host = endpoint.split("://", 1)[-1].rstrip("/")
        conf["spark.hadoop.fs.s3a.endpoint"] = host
        conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] = str(secure).lower()
    return conf


def bucket_root(bucket: str) -> str:
    """Zone root inside a bucket."""
    return f"s3a://{bucket}"
