"""Options of one run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from isospread import registry
from isospread.functions import naming
from isospread.functions.text import parse_kwargs
from isospread.registry import Ensemble, resolve_ensemble

TEST_MEMBERS = 2
TEST_TIMES = 10


@dataclass(frozen=True)
class RunOptions:
    """What to analyse and where to save it.

    Truncating time needs ``test_members`` as well; only then is the result marked as a test.
    """

    ensemble: str | Ensemble
    data_freq: str
    variables: tuple[str, ...]
    save_path: str = ""
    field_name: str = "analysis"
    timestr: str | None = None
    match: str = "contains"
    concat_results: bool = True
    skip_analysis: bool = False
    skip_preprocess: bool = True
    preprocess_kwargs: str | Mapping[str, str] = field(default_factory=dict)
    use_provided_casenames: bool = False
    casenames_path: str | None = None
    test_members: bool = False
    test_times: bool = False
    strict: bool = False

    def __post_init__(self) -> None:
        for name in (
            "concat_results", "skip_analysis", "skip_preprocess", "use_provided_casenames",
            "test_members", "test_times", "strict",
        ):
            if not isinstance(getattr(self, name), bool):
                raise ValueError(f"{name} must be True or False, not {getattr(self, name)!r}")
        if self.match not in ("contains", "exact"):
            raise ValueError(f"match must be 'contains' or 'exact', not {self.match!r}")
        if isinstance(self.variables, str) or not self.variables:
            raise ValueError("variables must be a non-empty list of names")
        object.__setattr__(self, "variables", tuple(self.variables))
        object.__setattr__(self, "ensemble", resolve_ensemble(self.ensemble))
        if isinstance(self.preprocess_kwargs, str):
            object.__setattr__(self, "preprocess_kwargs", parse_kwargs(self.preprocess_kwargs))
        registry.merge_mode(self.data_freq)

    @property
    def merge_mode(self) -> str:
        return registry.merge_mode(self.data_freq)

    @property
    def truncates_time(self) -> bool:
        return self.test_members and self.test_times

    @property
    def data_path(self) -> str:
        return registry.data_path(self.ensemble, self.data_freq)

    @property
    def save_name(self) -> str:
        return naming.save_name(self.data_freq, self.field_name)

    @property
    def case_list(self) -> str:
        if self.casenames_path:
            return self.casenames_path
        folder = naming.ensemble_folder(self.save_path, self.ensemble.name)
        return folder + naming.case_list_name(self.ensemble.name)

    @property
    def members_path(self) -> str:
        folder = naming.members_folder(self.save_path, self.ensemble.name)
        return folder + naming.dataset_name(
            self.ensemble.name, self.save_name,
            timestr=self.timestr, testing=self.truncates_time,
        )

    def combined_path(self, n_members: int) -> str:
        folder = naming.ensemble_folder(self.save_path, self.ensemble.name)
        return folder + naming.dataset_name(
            self.ensemble.name, self.save_name, f"{n_members}members",
            timestr=self.timestr, testing=self.truncates_time,
        )
