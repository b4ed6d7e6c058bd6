"""Column expressions and Arrow kernels: tokens, hash-uniforms, vector distances."""
