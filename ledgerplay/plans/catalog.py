"""Imports every query module so that all queries are registered."""

from ledgerplay.plans import q_abtest, q_clean, q_eval, q_game, q_misc, q_mixture, q_models, q_payments, q_pricing, q_turns, q_variants  # noqa: F401
