"""Compositions: input views, registered queries, the end-to-end job."""
