"""Addresses and credentials of object storage as session settings. The Hadoop connector does the I/O."""

from __future__ import annotations

import os
from collections.abc import Mapping

# Setting names of the Azure connector, and the environment names operators know.
_PREFIX = "spark.hadoop.fs.azure.account"
_CLIENT_CREDENTIALS = "org.apache.hadoop.fs.azurebfs.oauth2.ClientCredsTokenProvider"
_LOGIN = "https://login.microsoftonline.com"
DEFAULT_CONTAINER = "edgar-full-index"


def account_settings(
    account: str, *, key: str = "", client: tuple[str, str, str] | None = None, managed: bool = False
) -> dict[str, str]:
    """Settings that let a session read ``account``. ``client`` is (tenant, id, secret).

    An account key goes before a service principal, that before a managed identity; with none of them, or no account,
    there is nothing to set.
    """
    host = f"{account}.dfs.core.windows.net"
    if account and key:
        return {f"{_PREFIX}.key.{host}": key}
    if account and client:
        tenant, client_id, secret = client
        return {
            f"{_PREFIX}.auth.type.{host}": "OAuth",
            f"{_PREFIX}.oauth.provider.type.{host}": _CLIENT_CREDENTIALS,
            f"{_PREFIX}.oauth2.client.endpoint.{host}": f"{_LOGIN}/{tenant}/oauth2/token",
            f"{_PREFIX}.oauth2.client.id.{host}": client_id,
            f"{_PREFIX}.oauth2.client.secret.{host}": secret,
        }
    return {f"{_PREFIX}.auth.type.{host}": "ManagedIdentity"} if account and managed else {}


def settings_from(environment: Mapping[str, str] = os.environ) -> dict[str, str]:
    """The same from environment variables; ``build_session`` applies them."""
    get = environment.get
    client = (get("AZURE_TENANT_ID", ""), get("AZURE_CLIENT_ID", ""), get("AZURE_CLIENT_SECRET", ""))
    return account_settings(
        get("AZURE_STORAGE_ACCOUNT", ""), key=get("AZURE_STORAGE_KEY", ""), client=client if client[1] else None,
        managed=get("AZURE_MANAGED_IDENTITY", "").lower() == "true",
    )


def container_root(account: str, container: str = DEFAULT_CONTAINER, scheme: str = "abfss") -> str:
    """The address of a container: ``abfss`` through the file endpoint, ``wasbs`` through the blob endpoint."""
    endpoint = {"abfss": "dfs", "wasbs": "blob"}[scheme]
    return f"{scheme}://{container}@{account}.{endpoint}.core.windows.net"


def index_path(root: str, year: str = "*", quarter: str = "*") -> str:
    """Path, or glob, of the quarterly index files below ``root``."""
    return f"{root.rstrip('/')}/full-index/{year}/{quarter}/company.gz"
