"""DataFrame-to-DataFrame operators. All are lazy unless their description says otherwise."""
