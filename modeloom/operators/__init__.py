"""DataFrame operators: profile, fit, encode, decode, evaluate, synthesise."""
