"""Part of panelwright."""
