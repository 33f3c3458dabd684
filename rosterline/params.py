"""Run parameters: department map, task switches, fixed clock values, labels.

"now" is never read from the clock inside a query: every statement that needs
it receives ``run_ts`` / ``as_of`` so that results repeat and can be checked.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# The seven sync tasks, in the order the service runs them.
TASKS = (
    "acct_insert_missing",      # new roster people become accounts
    "logon_insert_missing",     # every account gets a logon row
    "cred_backfill",            # blank credentials get the default digest
    "people_insert_missing",    # new roster people become person rows
    "people_link_account",      # person.sys_user points at its account
    "acct_disable_leavers",     # leavers' accounts are disabled
    "people_job_status",        # person job status follows the roster flag
)


def dedup_ordered(items) -> list:
    """A5: distinct items, first-seen order, ordinal comparison (tiny config lists)."""
    return list(dict.fromkeys(items))


@dataclass(frozen=True)
class SyncParams:
    # ordered (department, factory) pairs; first matching entry wins
    dept_map: tuple = (
        ("AUTOMOBILE", "1030,1010"),
        ("BUILDING", "1060"),
        ("FURNITURE", "1030"),
        ("HOUSEHOLD", "1040"),
    )
    default_factory: str = ""
    tasks: dict = field(default_factory=lambda: {t: True for t in TASKS})

    # clock replacements
    run_ts: str = "2024-02-01 02:00:00"
    picking_as_of: str = "1996-12-15 00:00:00"
    window_days: int = 15
    log_as_of: str = "2024-01-31 00:00:00"
    retain_days: int = 14
    attendance_day: str | None = "20240115"     # None: today

    # constants of the scripts
    single_dept: str = "BUILDING"
    protected_groups: tuple = ("NATION_7", "NATION_8")
    keeper_level4: str = "Supplier#000000007"
    keeper_level5: tuple = tuple(f"Supplier#{i:09d}" for i in range(11, 22))
    default_secret: str | None = None   # required where credentials are written
    run_salt: str | None = None         # required there too: makes derived keys unpredictable
    system_user: str = "system"
    org: str = "org-1"
    enterprise_id: str = "ent-1"
    role_id: str = "role-default"
    organize_id: str = "dept-default"
    live_mode: str = "service"          # F8: "service" or "script"

    @property
    def secret(self) -> str:
        """The default secret; there is none unless it was given."""
        if not self.default_secret:
            raise ValueError("default_secret is required to write credentials")
        return self.default_secret

    @property
    def key_seed(self) -> str:
        """What row ids are combined with in generated keys."""
        if not self.run_salt:
            raise ValueError("run_salt is required to write credentials")
        return self.run_ts + self.run_salt

    def dept_names(self) -> list:
        """trimmed, non-empty, ordinally distinct names in first-seen order."""
        names = [d.strip() for d, _ in self.dept_map if d and d.strip()]
        if not names:
            raise ValueError("dept_map needs at least one non-empty department name")
        return dedup_ordered(names)

    def dept_pairs(self) -> list:
        return [(d.strip(), f if f is not None else "") for d, f in self.dept_map
                if d and d.strip()]

    @classmethod
    def from_config(cls, doc: dict) -> "SyncParams":
        """SRC3: build from a JSON-like document.

        ``dept_map``: ordered list of {"dept": ..., "factory": ...}; at least one
        non-empty department after trimming (else ValueError). ``tasks``:
        switches by task name (missing ones stay on). Other keys override the
        defaults of the same name.
        """
        kw = {k: v for k, v in doc.items() if k not in ("dept_map", "tasks")}
        entries = doc.get("dept_map")
        if not entries:
            raise ValueError("dept_map must not be empty")
        kw["dept_map"] = tuple(((e.get("dept") or ""), e.get("factory") or "") for e in entries)
        flags = {t: True for t in TASKS}
        for k, v in (doc.get("tasks") or {}).items():
            if k not in flags:
                raise ValueError(f"unknown task {k!r}")
            flags[k] = bool(v)
        kw["tasks"] = flags
        for k in ("protected_groups", "keeper_level5"):
            if k in kw:
                kw[k] = tuple(kw[k])
        p = cls(**kw)
        p.dept_names()      # validates: at least one non-empty name
        return p

    @classmethod
    def load(cls, path: str) -> "SyncParams":
        import json
        with open(path, encoding="utf-8") as f:
            return cls.from_config(json.load(f))

    def with_tasks(self, **flags) -> "SyncParams":
        t = dict(self.tasks)
        t.update(flags)
        return SyncParams(**{**self.__dict__, "tasks": t})


# Parameters of the registered queries: fixed, so that results repeat. A real
# run gives its own secret and a fresh salt (from_config has no default for them).
DEFAULT_PARAMS = SyncParams(default_secret="fixture-secret", run_salt="fixture-salt")

# English stand-ins for the reference's labels (order as used).
JOB_LABELS = {0: "active", 1: "left"}
JOB_UNKNOWN = "unknown"
ATTENDANCE_BUCKETS = (("normal", "normal"), ("late", "late"),
                      ("absent", "absent"), ("leave", "leave"))
ATTENDANCE_UNKNOWN = "unknown"
LINE_SIGNED = "signed"
LINE_ISSUING = "issuing"
