"""Typed inputs, site settings and routed outputs."""
