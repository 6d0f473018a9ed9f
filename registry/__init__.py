"""Registered queries: each module pairs library calls with their check SQL."""
