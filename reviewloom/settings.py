"""Connection settings. Secrets come from the environment, never from a module."""

import os
from dataclasses import dataclass, field


# The login module of each mechanism that takes a name and a password.
LOGIN_MODULES = {
    "PLAIN": "org.apache.kafka.common.security.plain.PlainLoginModule",
    "SCRAM-SHA-256": "org.apache.kafka.common.security.scram.ScramLoginModule",
    "SCRAM-SHA-512": "org.apache.kafka.common.security.scram.ScramLoginModule",
}


def _jaas_quote(text):
    return '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"'


@dataclass(frozen=True)
class KafkaSettings:
    servers: str
    security_protocol: str = "SASL_SSL"
    mechanism: str = "PLAIN"
    username: str | None = None
    password: str | None = field(default=None, repr=False)
    session_timeout_ms: int | None = None

    @classmethod
    def from_env(cls, env=None):
        env = os.environ if env is None else env
        timeout = env.get("KAFKA_SESSION_TIMEOUT_MS")
        return cls(
            servers=env["KAFKA_BOOTSTRAP_SERVERS"],
            security_protocol=env.get("KAFKA_SECURITY_PROTOCOL", "SASL_SSL"),
            mechanism=env.get("KAFKA_SASL_MECHANISM", "PLAIN"),
            username=env.get("KAFKA_SASL_USERNAME"),
            password=env.get("KAFKA_SASL_PASSWORD"),
            session_timeout_ms=int(timeout) if timeout else None,
        )

    @classmethod
    def from_properties(cls, props):
        """From a dictionary keyed by the usual Kafka client property names."""
        timeout = props.get("session.timeout.ms")
        return cls(
            servers=props["bootstrap.servers"],
            security_protocol=props.get("security.protocol", "SASL_SSL"),
            mechanism=props.get("sasl.mechanisms", props.get("sasl.mechanism", "PLAIN")),
            username=props.get("sasl.username"),
            password=props.get("sasl.password"),
            session_timeout_ms=int(timeout) if timeout else None,
        )

    def options(self):
        """Connection options for the Kafka source and sink alike."""
        out = {
            "kafka.bootstrap.servers": self.servers,
            "kafka.security.protocol": self.security_protocol,
        }
        if self.security_protocol.startswith("SASL"):
            if self.username is None or self.password is None:
                raise ValueError(f"{self.security_protocol} needs a username and a password")
            if self.mechanism not in LOGIN_MODULES:
                raise ValueError(f"mechanism must be one of {', '.join(LOGIN_MODULES)}, not {self.mechanism!r}")
            out["kafka.sasl.mechanism"] = self.mechanism
            out["kafka.sasl.jaas.config"] = (
                f"{LOGIN_MODULES[self.mechanism]} required "
                f"username={_jaas_quote(self.username)} password={_jaas_quote(self.password)};"
            )
        return out

    def consumer_options(self):
        """Connection options plus the settings only a consumer reads."""
        out = self.options()
        if self.session_timeout_ms is not None:
            out["kafka.session.timeout.ms"] = str(self.session_timeout_ms)
        return out
