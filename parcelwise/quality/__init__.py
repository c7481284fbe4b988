"""Declarative rules, singular invariants and the gate that blocks a release."""
