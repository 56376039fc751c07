"""A pipeline's configuration: sections with defaults, environment variables over files, and rules."""

from __future__ import annotations

import dataclasses
import json
import os
from dataclasses import dataclass, field

from driftvault.functions.codecs import codec_name
from driftvault.functions.templates import PLACEHOLDERS, unknown_placeholders
from driftvault.operators.archive import Layout
from driftvault.operators.batching import Limits
from driftvault.operators.routing import DEFAULT_FIELDS
from driftvault.sources.stores import SCHEMES, Store, parse_destination

PREFIX = "DRIFTVAULT_"
#: How the dead-letter outputs are used where both are there.
DLQ_MODES = ("cascade", "fan_out", "file_only", "kafka_only")

# The defaults of the sections below are fixed values: what a configuration means that leaves a setting out.


@dataclass
class Kafka:
    brokers: list[str] = field(default_factory=lambda: ["localhost:9092"])
    group_id: str = "driftvault"
    topics: list[str] = field(default_factory=list)
    topic_include: list[str] = field(default_factory=list)
    topic_exclude: list[str] | None = None
    topic_refresh_secs: int = 60
    security_protocol: str = "PLAINTEXT"
    sasl_mechanism: str | None = None
    sasl_username: str | None = None
    sasl_password: str | None = None
    ssl_ca_location: str | None = None
    batch_size: int = 10_000
    acknowledgements: bool = True


@dataclass
class Grpc:
    listen: str | None = "0.0.0.0:6000"
    max_message_size: int = 16 << 20
    acknowledgements: bool = True


@dataclass
class Archive:
    destination: str = ""
    path_template: str = "{year}/{month}/{day}/{hour}"
    file_extension: str = "jsonl"
    roll_size_bytes: int = 1 << 30
    roll_interval_secs: int | None = None
    multipart_chunk_size: int = 8 << 20
    bucket: str | None = None
    endpoint: str | None = None
    region: str | None = None
    access_key: str | None = None
    secret_key: str | None = None
    account: str | None = None
    allow_http: bool = False
    service_account_key: str | None = None


@dataclass
class Buffer:
    flush_bytes: int = 1 << 20
    flush_age_secs: int = 60
    flush_records: int = 100_000
    writer_parallelism: int = 2
    writer_tasks: int | None = None
    hold: bool = False
    hold_bytes: int = 64 << 20


@dataclass
class Routing:
    mode: str = "expression"
    expression_fields: list[str] | None = None
    default_segment: str = "default"


@dataclass
class Compression:
    codec: str = "zstd"
    level: int = 3
    enabled: bool = True


@dataclass
class DlqFile:
    enabled: bool = True
    path: str | None = None
    rotation: str = "hourly"
    max_age_days: int = 30
    compress_rotated: bool = True


@dataclass
class DlqKafka:
    enabled: bool = True
    routing: str = "common"
    topic_suffix: str = ".dlq"
    common_topic: str = "driftvault_dlq"


@dataclass
class Dlq:
    enabled: bool = True
    mode: str = "cascade"
    max_bytes: int = 1_000_000
    max_payload_bytes: int | None = 524_288
    file: DlqFile = field(default_factory=DlqFile)
    kafka: DlqKafka = field(default_factory=DlqKafka)


class ConfigError(ValueError):
    pass


@dataclass
class Config:
    transport: str = "kafka"
    kafka: Kafka = field(default_factory=Kafka)
    grpc: Grpc = field(default_factory=Grpc)
    archive: Archive = field(default_factory=Archive)
    buffer: Buffer = field(default_factory=Buffer)
    routing: Routing = field(default_factory=Routing)
    compression: Compression = field(default_factory=Compression)
    dlq: Dlq = field(default_factory=Dlq)

    @classmethod
    def load(cls, values: dict | None = None, env: dict[str, str] | None = None) -> Config:
        """Defaults, with `values` over them and the environment over both: PREFIX + SECTION_KEY. An empty variable
        is as good as none, and what a block leaves out or sets to null keeps its default, however deep it lies."""
        config = _filled(cls(), values or {}, os.environ if env is None else env, PREFIX)
        if config.kafka.sasl_username and config.kafka.sasl_password and not config.kafka.sasl_mechanism:
            config.kafka.sasl_mechanism = "PLAIN"
        return config

    @classmethod
    def from_files(cls, path: str | None = None, env_file: str | None = None, env: dict[str, str] | None = None) -> Config:
        """load() of a YAML or JSON file, under the variables of env_file, under those of the environment."""
        values: dict = {}
        if path:
            with open(path, encoding="utf-8") as f:
                values = _parsed_file(f.read(), path) or {}
        variables: dict[str, str] = {}
        if env_file and os.path.exists(env_file):
            with open(env_file, encoding="utf-8") as f:
                variables = env_values(f.read())
        given = {k: v for k, v in (os.environ if env is None else env).items() if v}
        return cls.load(values, variables | given)

    def is_direct(self) -> bool:
        return self.transport == "grpc"

    def is_acknowledged(self) -> bool:
        return self.grpc.acknowledgements if self.is_direct() else self.kafka.acknowledgements

    def holds_offsets(self) -> bool:
        return not self.is_direct() and self.kafka.acknowledgements

    def roll_interval_secs(self) -> int:
        """As given; else short where offsets wait for files to close, or pushes are answered early, and an hour otherwise."""
        return self.archive.roll_interval_secs or (300 if self.holds_offsets() or self.is_direct() else 3600)

    def effective_fields(self) -> tuple[str, ...]:
        return tuple(DEFAULT_FIELDS.get(self.transport, ()) if self.routing.expression_fields is None else self.routing.expression_fields)

    def long_held_roll_interval(self) -> int | None:
        """The roll interval, where offsets wait for it longer than a quarter of an hour and memory may grow."""
        seconds = self.roll_interval_secs()
        return seconds if self.holds_offsets() and seconds > 900 else None

    def restart_required(self, new: Config) -> list[str]:
        """The sections in which `new` differs by more than kafka.batch_size, which is taken over between two batches."""
        mine, theirs = dataclasses.asdict(self), dataclasses.asdict(new)
        mine["kafka"]["batch_size"] = theirs["kafka"]["batch_size"]
        return [k for k in mine if mine[k] != theirs[k]]

    def codec(self) -> str:
        return codec_name(self.compression.codec, self.compression.enabled)

    def idle_reason(self) -> str | None:
        return None if self.archive.destination.strip() else "archive.destination is empty: there is nowhere to write"

    def guarantee(self) -> tuple[str, str | None]:
        """The delivery guarantee, and what keeps it from being more."""
        if not self.is_acknowledged():
            return "best_effort", "acks_disabled"
        return ("best_effort", "sink_cannot_confirm") if self.is_direct() else ("at_least_once", None)

    def backend(self) -> str:
        """The store's label: by scheme, else `minio` where an endpoint is given, else `file`."""
        if "://" in self.archive.destination:
            scheme = parse_destination(self.archive.destination)[0]
            if scheme != "file":
                return {"gs": "gcs", "az": "azure"}.get(scheme, scheme)
        return "minio" if self.archive.endpoint else "file"

    def bucket(self) -> str | None:
        """The block's bucket, else the destination's."""
        return self.archive.bucket or parse_destination(self.archive.destination)[1]

    def store(self) -> Store:
        """The destination as tasks open it."""
        a = self.archive
        scheme, _, prefix = parse_destination(a.destination)
        uri = a.destination if scheme == "file" else f"{scheme}://{self.bucket()}/{prefix}"
        settings = {"key": a.access_key, "secret": a.secret_key, "region": a.region, "endpoint": a.endpoint, "allow_http": a.allow_http or None, "account": a.account, "service_account_key": a.service_account_key if scheme == "gs" else None,
                    "chunk": a.multipart_chunk_size or None if scheme != "file" else None}
        return Store(uri.rstrip("/"), {k: v for k, v in settings.items() if v is not None})

    def tables(self, folder: str) -> str:
        """The URI by which Spark itself reads and writes tables in a folder of the destination."""
        scheme, _, prefix = parse_destination(self.archive.destination)
        if scheme == "file":
            return f"file://{os.path.abspath(prefix)}/{folder}"
        at = "/".join(x for x in (prefix, folder) if x)
        if scheme == "az":
            return f"abfss://{self.bucket()}@{self.archive.account}.dfs.core.windows.net/{at}"
        return f"{'gs' if scheme == 'gs' else 's3a'}://{self.bucket()}/{at}"

    def hadoop_options(self) -> dict[str, str]:
        """The destination's settings for Spark's own object-store clients, as options of a reader or writer."""
        a, scheme = self.archive, parse_destination(self.archive.destination)[0]
        if scheme in ("s3", "minio"):
            given = {
                "fs.s3a.endpoint": a.endpoint, "fs.s3a.endpoint.region": a.region, "fs.s3a.access.key": a.access_key, "fs.s3a.secret.key": a.secret_key,
                "fs.s3a.path.style.access": "true" if a.endpoint else None, "fs.s3a.connection.ssl.enabled": "false" if a.allow_http else None,
                "fs.s3a.multipart.size": str(a.multipart_chunk_size) if a.multipart_chunk_size else None, "fs.s3a.fast.upload.active.blocks": "4",
            }
        elif scheme == "gs":
            given = {"fs.gs.storage.root.url": a.endpoint, "fs.gs.auth.service.account.json.keyfile": None}
        elif scheme == "az" and a.account:
            given = {f"fs.azure.account.key.{a.account}.dfs.core.windows.net": a.secret_key}
        else:
            given = {}
        return {k: v for k, v in given.items() if v is not None}

    def dead_letters_kept(self) -> bool:
        """Whether there is a dead-letter output: a direct transport has no broker to send them to, so there it is off."""
        return self.dlq.enabled and not self.is_direct()

    def dead_letter_limit(self) -> int:
        """The largest payload that the dead-letter outputs take: any, where larger ones are cut to what they take."""
        cut = self.dlq.max_payload_bytes
        return self.dlq.max_bytes if cut is None or cut > self.dlq.max_bytes else 1 << 62

    def limits(self) -> Limits:
        b = self.buffer
        return Limits(b.flush_bytes, b.flush_records, b.flush_age_secs, self.archive.roll_size_bytes, self.roll_interval_secs())

    def layout(self) -> Layout:
        return Layout(self.archive.path_template, self.archive.file_extension, self.codec(), self.compression.level)

    def validate(self) -> None:
        """Raises ConfigError with the first rule that is broken."""
        k, b, a = self.kafka, self.buffer, self.archive
        scheme = a.destination.partition("://")[0] if "://" in a.destination else "file"
        rules = [
            (scheme in SCHEMES, f"archive.destination: {scheme}:// is unknown; known are {', '.join(SCHEMES)}"),
            (self.transport in ("kafka", "grpc"), f"transport must be kafka or grpc, not {self.transport!r}"),
            (not self.is_direct() or bool((self.grpc.listen or "").strip()), "grpc.listen is needed when transport is grpc"),
            (self.is_direct() or bool(k.brokers), "kafka.brokers must not be empty"),
            (self.is_direct() or bool(k.group_id), "kafka.group_id must not be empty"),
            (self.is_direct() or not k.sasl_mechanism or bool(k.sasl_username and k.sasl_password), "kafka.sasl_mechanism needs kafka.sasl_username and kafka.sasl_password"),
            *[(n > 0, f"{key} must be greater than 0") for n, key in (
                (k.batch_size, "kafka.batch_size"), (b.flush_bytes, "buffer.flush_bytes"), (b.flush_records, "buffer.flush_records"), (b.writer_parallelism, "buffer.writer_parallelism"), (b.hold_bytes, "buffer.hold_bytes"))],
            (not unknown_placeholders(a.path_template), f"archive.path_template: {', '.join(unknown_placeholders(a.path_template))} unknown; known are {', '.join(PLACEHOLDERS)}"),
            (a.multipart_chunk_size == 0 or a.multipart_chunk_size >= 5 << 20, "archive.multipart_chunk_size must be 0 or at least 5 MiB"),
            (self.compression.codec in ("none", "zstd", "lz4", "snappy", "gzip"), f"compression.codec {self.compression.codec!r} is unknown"),
            (self.routing.mode in ("topic", "expression"), f"routing.mode must be topic or expression, not {self.routing.mode!r}"),
            (self.routing.mode != "expression" or bool(self.effective_fields()), "routing.expression_fields must not be empty"),
            ((a.service_account_key or "{").lstrip().startswith("{"), "archive.service_account_key holds the key's JSON itself, not a path"),
            (self.dlq.mode in DLQ_MODES, f"dlq.mode must be one of {', '.join(DLQ_MODES)}, not {self.dlq.mode!r}"),
            (self.dlq.file.rotation in ("hourly", "daily"), f"dlq.file.rotation must be hourly or daily, not {self.dlq.file.rotation!r}"),
            (not (self.dead_letters_kept() and self.routing.mode == "expression" and self.dlq.kafka.enabled and self.dlq.mode != "file_only" and self.dlq.kafka.routing == "per_table"),
             "dlq.kafka.routing: per_table names topics after destinations, which expression routing puts a / in; use common"),
        ]
        for holds, message in rules:
            if not holds:
                raise ConfigError(message)


def _filled(part, given: dict, env: dict[str, str], prefix: str):
    """part, a dataclass with its defaults, with what `given` has over them and the variables PREFIX_KEY over both."""
    for key in dataclasses.fields(part):
        value, name = given.get(key.name), f"{prefix}{key.name}".upper()
        if dataclasses.is_dataclass(getattr(part, key.name)):
            setattr(part, key.name, _filled(getattr(part, key.name), value or {}, env, f"{name}_"))
        elif env.get(name):
            setattr(part, key.name, _parsed(env[name], key.type))
        elif value is not None:
            setattr(part, key.name, value)
    return part


def _parsed(text: str, kind: str):
    if "list" in kind:
        return [x.strip() for x in text.split(",") if x.strip()]
    if "bool" in kind:
        return text.lower() in ("1", "true", "yes", "on")
    return int(text) if "int" in kind else text


def _parsed_file(text: str, path: str):
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise ConfigError(f"{path}: YAML needs the yaml package; JSON is read without it") from e
    return yaml.safe_load(text)


def env_values(text: str) -> dict[str, str]:
    """The variables of a .env file: KEY=VALUE lines, with or without `export` and quotes; # begins a comment line."""
    lines = [x.strip().removeprefix("export ").partition("=") for x in text.splitlines() if "=" in x and not x.lstrip().startswith("#")]
    return {k.strip(): v.strip().strip("\"'") for k, _, v in lines}
