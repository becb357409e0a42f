"""Composed jobs: the training run (K2), the profile run (K3), serving
(J1, J3, J4), the configuration (K4) and the registered queries."""
