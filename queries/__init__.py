"""Registered queries: every operator run over whole test tables, with its SQL twin."""
