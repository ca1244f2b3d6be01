"""Rules by name, and the entry points for user code."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from trajtable.functions import userland
from trajtable.operators import advantage, audit, correction, distill

Rule = Callable[..., DataFrame]

ADVANTAGES: dict[str, Rule] = {
    "gae": advantage.gae,
    "grpo": advantage.grpo,
    "grpo_vectorized": advantage.grpo_from_table,
    "gdpo": advantage.gdpo,
    "grpo_passk": advantage.grpo_passk,
    "reinforce_plus_plus": advantage.reinforce_pp,
    "reinforce_plus_plus_baseline": advantage.reinforce_pp_baseline,
    "remax": advantage.remax,
    "rloo": advantage.rloo,
    "rloo_vectorized": advantage.rloo_from_sums,
    "opo": advantage.opo,
    "gpg": advantage.gpg,
    "optimal_token_baseline": advantage.token_baseline,
    "tir_optimal_token_baseline": lambda df, **kw: advantage.token_baseline(df, packed=True, **kw),
}
LOSSES: dict[str, Rule] = {
    "vanilla": audit.ppo,
    "dppo_tv": lambda df, **kw: audit.dppo(df, "tv", **kw),
    "dppo_kl": lambda df, **kw: audit.dppo(df, "kl", **kw),
    "gspo": audit.gspo,
    "sapo": audit.sapo,
    "gpg": audit.gpg,
    "clip_cov": audit.clip_cov,
    "kl_cov": audit.kl_cov,
    "geo_mean": audit.geo_mean,
    "cispo": audit.cispo,
    "reinforce": audit.reinforce,
    "bypass_mode": lambda df, **kw: audit.ppo(correction.bypass(df), **kw),
}
DISTILLATIONS: dict[str, Rule] = {
    **{k: (lambda df, kind=k, **kw: distill.reverse_kl(df, kind, **kw)) for k in ("kl", "k1", "abs", "mse", "k2", "low_var_kl", "k3")},
    "forward_kl_topk": distill.topk_tables,
    "mixed_reverse_kl": lambda df, **kw: distill.mixed_objective(df, "rkl", **kw),
    "mixed_forward_kl_topk": lambda df, **kw: distill.mixed_objective(df, "fkl", **kw),
    "forward_kl_topk_renorm": lambda df, k, **kw: distill.topk_tables(df, k, renorm=True, **kw),
}


class Registry:
    """Names to rules. A second, different rule under a name is an error unless ``replace`` is set."""

    def __init__(self, kind: str, rules: Mapping[str, Rule] | None = None, replace: bool = False):
        self.kind, self.replace, self._rules = kind, replace, dict(rules or {})

    def register(self, name: str, rule: Rule) -> Rule:
        known = self._rules.get(name)
        if known is not None and known is not rule and not self.replace:
            raise ValueError(f"{self.kind} rule {name} is already registered")
        self._rules[name] = rule
        return rule

    def get(self, name: str) -> Rule:
        if name not in self._rules:
            raise ValueError(f"unknown {self.kind} rule {name}; known: {sorted(self._rules)}")
        return self._rules[name]


reward_function = userland.reward_function
explode_function = userland.explode_function
